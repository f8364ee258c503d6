"""Public names "stop, city": column rules in order, the first that fits decides; then the resolved city takes over.

Each rule gives a struct (stop, city, source) or null.  A resolved city is stripped
from a name in up to STEPS steps: the city with a qualifier, the city itself, a code
that stands for it, a qualifier alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from . import graph, names
from .names import any_of, first_filled, spaced

STEPS = 4
# --- fixed values of the contract: patterns and words ---
LEVEL = r"\((?:oben|tief|upper|lower|s|u|s\s*\+?\s*u|bus|tram)\)"
STREET = r"(?:straße|strasse|str)\.?(?!\p{L})"
MODE_SUFFIXES = ["s", "u", "su", "s u", "s und u", "s bahn", "u bahn", "stadtbahn", "bus", "tram"]
QUALIFIERS = ["oben", "tief", "upper", "lower", "s", "u", "s u", "su", "bus", "tram"]
LEADING_STATIONS = ["hauptbahnhof", "hbf", "ostbahnhof", "westbahnhof", "nordbahnhof", "suedbahnhof", "sudbahnhof", "bahnhof"]
PARTICLES = ["am", "an", "auf", "bei", "der", "dem", "den", "im", "in", "ob", "unter", "vor"]
STREET_ENDS = r"(?:str|strasse|weg|platz|allee|gasse|ring|chaussee|damm|ufer|bruecke)$"
NO_LOCALITY = (
    "abzw abzweig abzweigung alt alte alten alter altes anhalter am an auf bei busbahnhof busstation dem den der dorf ehem ehemalig ehemalige ehemaliger flughafen gegenueber goerlitzer hinter holzkirchner im in naehe "
    "nord oberer ost post richtung schweizer sued unter unterer vor west zob zum zur bayerischer"
).split()
# --- end of fixed values ---
PARTS = "struct<stop:string,city:string,source:string>"


def clean(text: Column) -> Column:
    return spaced(F.replace(F.coalesce(text, F.lit("")), F.lit("/"), F.lit(" ")))


def clean_city(text: Column) -> Column:
    bare = F.trim(F.regexp_replace(clean(text), r"\s*\([^)]*\)", ""))
    codes = F.create_map(*[F.lit(x) for k, v in names.CODES.items() if k != names.WORD_CODE for x in (k, v)])
    return F.coalesce(codes[F.upper(bare)], bare)


def streets(text: Column) -> Column:
    """Endings for street in their short form, capital where they begin a word."""
    return F.regexp_replace(F.regexp_replace(text, r"(?iu)(?<![\p{L}\p{N}])" + STREET, "Str."), r"(?iu)(?<=[\p{L}\p{N}])" + STREET, "str.")


def clean_stop(text: Column) -> Column:
    """A stop's part: no levels, stations spelled out, streets short."""
    out = F.regexp_replace(clean(text), r"(?iu)\s*" + LEVEL + r"\s*", " ")
    for short, whole in (("hbf", "Hauptbahnhof"), ("bf", "Bahnhof"), ("bhf", "Bahnhof")):
        out = F.regexp_replace(out, rf"(?i)\b{short}\b\.*", whole)
    return F.trim(F.replace(F.replace(streets(spaced(out)), F.lit("hauptbahnhof"), F.lit("Hauptbahnhof")), F.lit("HBF"), F.lit("Hauptbahnhof")))


def mode_free(text: Column) -> Column:
    return names.without_mode(clean(text))


def says_station(text: Column) -> Column:
    return names.station_words(c.plain(text))


def same(a: Column, b: Column) -> Column:
    return c.plain(a) == c.plain(b)


def parts(stop: Column, city: Column, source: str) -> Column:
    """The struct, or null unless both parts are filled."""
    return F.when((stop != "") & (city != ""), F.struct(stop.alias("stop"), city.alias("city"), F.lit(source).alias("source")))


def station_behind(text: Column, source: str = "CITY_STATION_INTENT") -> Column:
    """City before the first later word that says station."""
    words = F.split(clean(text), " ")
    at = F.array_position(F.transform(words, lambda w, k: (k > 0) & says_station(w)), True).cast("int")
    city, stop = F.array_join(F.slice(words, F.lit(1), F.greatest(at - 1, F.lit(0))), " "), F.array_join(F.slice(words, F.greatest(at, F.lit(1)), F.size(words)), " ")
    return F.when(at > 1, parts(clean_stop(stop), clean_city(city), source))


def station_first(text: Column, source: str = "TRAILING_CITY_STATION") -> Column:
    """City behind a station word at the beginning."""
    bare = mode_free(text)
    n = c.plain(bare)
    head = F.substring_index(bare, " ", 1)
    rest = F.trim(F.substring(bare, F.length(head) + 1, F.length(bare)))
    return F.when(any_of([n.startswith(f"{w} ") for w in LEADING_STATIONS]), parts(clean_stop(head), clean_city(rest), source))


def leading_code(text: Column) -> Column:
    bare = clean(text)
    codes = F.create_map(*[F.lit(x) for k, v in names.CODES.items() if k != names.WORD_CODE for x in (k, v)])
    of = lambda sep: codes[F.upper(F.substring_index(bare, sep, 1))]
    rest = lambda sep: clean_stop(F.substring(bare, F.locate(sep, bare) + 1, F.length(bare)))
    dash, space = F.when(bare.contains("-"), of("-")), F.when(bare.contains(" "), of(" "))
    return F.when(dash.isNotNull(), parts(rest("-"), dash, "LEADING_CITY_CODE")).when(space.isNotNull(), parts(rest(" "), space, "LEADING_CITY_CODE"))


def in_parentheses(text: Column) -> Column:
    """City in the last parentheses behind a station."""
    value = F.coalesce(text, F.lit(""))
    before, inside = F.trim(F.regexp_extract(value, r"^(.+)\(([^()]+)\)[^)]*$", 1)), F.regexp_extract(value, r"^(.+)\(([^()]+)\)[^)]*$", 2)
    city, stop = clean_city(inside), clean_stop(mode_free(before))
    return F.when((before != "") & ~before.contains(",") & says_station(stop) & ~c.plain(city).isin(*QUALIFIERS), parts(stop, city, "PARENTHESIZED_CITY"))


def boundary_strip(text: Column, city: Column) -> Column:
    """Text without the city at its beginning, else at its end, where a word of it ends; compared in search form."""
    bare, place = clean(text), c.plain(city)
    cut = lambda test: F.filter(F.sequence(F.lit(1), F.greatest(F.length(bare), F.lit(1))), lambda k: F.substring(bare, k, F.lit(1)).rlike(r"[\s,/-]") & test(k))
    heads = cut(lambda k: (k > 1) & (c.plain(F.substring(bare, F.lit(1), k - 1)) == place))
    tails = cut(lambda k: c.plain(F.substring(bare, k + 1, F.length(bare))) == place)
    head, tail = F.get(heads, F.lit(0)), F.element_at(tails, -1)
    behind = F.regexp_replace(F.substring(bare, head, F.length(bare)), r"^[\s,/-]+", "")
    before = F.regexp_replace(F.substring(bare, F.lit(1), tail), r"[\s,/-]+$", "")
    return F.when((place == "") | (bare == ""), bare).when((F.size(heads) > 0) & (behind != ""), behind).when((F.size(tails) > 0) & (before != ""), before).otherwise(bare)


def by_comma(text: Column) -> Column:
    value = F.trim(F.coalesce(text, F.lit("")))
    at = F.locate(",", value)
    left, right = clean(F.substring(value, F.lit(1), at - 1)), clean_city(F.substring(value, at + 1, F.length(value)))
    free = mode_free(right)
    ok = (at > 1) & (at < F.length(value)) & (left != "") & (right != "")
    mode = c.plain(right).isin(*MODE_SUFFIXES)
    of_mode = F.coalesce(station_behind(left, "MODE_SUFFIX_CITY_STATION"), station_first(left, "MODE_SUFFIX_TRAILING_CITY"))
    a, b = says_station(left), says_station(right)
    return F.when(
        ok, F.when(mode, of_mode).when(a & (free != right) & (free != ""), parts(clean_stop(left), clean_city(free), "POSTPOSED_MODE_CITY")).when(a & ~b, parts(clean_stop(left), right, "POSTPOSED_CITY"))
        .when(~a & b, parts(clean_stop(boundary_strip(right, left)), clean_city(left), "CITY_COMMA_STATION")),
    )


def generic(text: Column) -> Column:
    bare = clean(text)
    head = F.substring_index(bare, " ", 1)
    return F.when(bare.contains(" "), parts(clean_stop(F.substring(bare, F.length(head) + 1, F.length(bare))), clean_city(head), "LEADING_CITY_GENERIC"))


def from_fields(original: Column, shown: Column, city: Column, station: Column, rail: Column) -> Column:
    """From a family's own city and station, where they say more than its name."""
    town, stop = clean_city(city), clean_stop(station)
    bare = c.plain(stop).isin("bahnhof", "bf")
    words = F.split(town, " ")
    district = clean_stop(F.substring(town, F.length(F.get(words, F.lit(0))) + 1, F.length(town)))
    whole = any_of([same(clean(x), clean(F.concat(town, F.lit(" "), y))) for x in (shown, original) for y in (stop, clean(station))])
    of_district = F.when(bare & (F.size(words) > 1) & ~c.plain(F.get(words, F.lit(1))).isin(*PARTICLES) & whole & (district != ""), parts(clean_stop(F.concat(district, F.lit(" "), stop)), clean_city(F.get(words, F.lit(0))), "DISTRICT_STATION_FIELDS"))
    only_city = same(clean(shown), town)
    fallback = F.when(rail & (town != "") & only_city & ~says_station(shown), parts(F.lit("Bahnhof"), town, "RAIL_CITY_FALLBACK"))
    told = (town != "") & (stop != "") & ~same(town, stop) & ~only_city & ~(bare & ~says_station(shown) & ~says_station(original))
    return F.coalesce(fallback, F.when(told, F.coalesce(of_district, parts(stop, town, "CANONICAL_FIELDS"))))


def inferred(df: DataFrame, original: str, shown: str, city: str | None, station: str | None, rail: str | None) -> DataFrame:
    """``df`` with ``_p``, the parts that the first fitting rule gives."""
    o, s, blank = F.col(original), F.col(shown), F.lit("")
    facility = mode_free(s)
    named = F.when(c.plain(facility).rlike("^flughafen(?: |$)"), F.struct(clean_stop(facility).alias("stop"), blank.alias("city"), F.lit("NAMED_FACILITY").alias("source")))
    rules = [leading_code(s), in_parentheses(o), in_parentheses(s), by_comma(o), by_comma(s), F.when(~says_station(s), station_behind(o)), named]
    rules += [from_fields(o, s, F.col(city), F.col(station), F.col(rail) == 1)] if city and station and rail else []
    rules += [station_behind(s), station_first(s), generic(s)]
    last = F.struct(clean_stop(s).alias("stop"), blank.alias("city"), F.lit("CANONICAL_ONLY").alias("source"))
    # one column a rule, so that no rule's expression holds the others
    tagged = graph.spread(df).withColumns({f"_r{k}": r.cast(PARTS) for k, r in enumerate(rules)})
    tagged = graph.written(tagged)
    return tagged.withColumn("_p", F.coalesce(*[F.col(f"_r{k}") for k in range(len(rules))], last)).drop(*[f"_r{k}" for k in range(len(rules))])


def chained(df: DataFrame, text: str, city: str, codes: str, out: str) -> DataFrame:
    """``df`` with ``out``: a struct of ``text`` without its city, in up to STEPS steps, and of what was taken (null if nothing)."""
    place = c.plain(F.col(city))
    rows = df.withColumns({"_t": clean(F.col(text)), "_how": F.array().cast("array<string>"), "_place": place})

    def qualified(t: Column) -> Column:
        pattern = r"^([^()]+?)(\s*)\(([^)]+)\)\s*(.+)$"
        part = lambda k: F.regexp_extract(t, pattern, k)
        base, mark = c.plain(part(1)), c.plain(part(3))
        of_base = (base != "") & ((F.col("_place") == base) | F.col("_place").startswith(F.concat(base, F.lit(" "))))
        of_mark = (F.length(mark) >= 3) & F.contains(F.concat(F.lit(" "), F.col("_place"), F.lit(" ")), F.concat(F.lit(" "), mark, F.lit(" ")))
        tight = (part(2) == "") & (F.col("_place") == base)
        return F.when(t.rlike(pattern) & of_base & (of_mark | tight), clean(F.regexp_replace(part(4), r"^[\s,./-]+", "")))

    def coded(t: Column) -> Column:
        limit = F.least(F.length(t), F.lit(names.PREFIX_CHARS))
        head, rest = (lambda k: F.trim(F.substring(t, F.lit(1), k - 1))), (lambda k: F.trim(F.substring(t, k + 1, F.length(t))))
        known = lambda k: F.exists(codes, lambda x: (x["code"] == names.prefix_code(head(k))) & (names.prefix_shape(head(k)) | (x["code"] == names.WORD_CODE))) & (rest(k) != "")
        space = F.locate(" ", t)
        marks = F.filter(F.sequence(F.lit(1), F.greatest(limit, F.lit(1))), lambda k: ((F.substring(t, k, F.lit(1)) == "-") | (k == space)) & known(k))
        at = F.element_at(marks, -1)
        learned = F.exists(codes, lambda x: (x["code"] == names.prefix_code(head(at))) & x["learned"])
        return F.when(F.size(marks) > 0, F.struct(rest(at).alias("t"), F.when(learned, "LEARNED").otherwise("CURATED_OR_DERIVED").alias("how")))

    def marked(t: Column) -> Column:
        mark = c.plain(F.regexp_extract(t, r"^\(([^)]+)\)\s+(.+)$", 1))
        fits = (F.length(mark) >= 3) & F.contains(F.concat(F.lit(" "), F.col("_place"), F.lit(" ")), F.concat(F.lit(" "), mark, F.lit(" ")))
        return F.when(fits, clean(F.regexp_extract(t, r"^\(([^)]+)\)\s+(.+)$", 2)))

    for _ in range(STEPS):
        t = F.col("_t")
        # written, so that no step's expression holds the steps before it
        rows = graph.written(rows.withColumns({"_q": qualified(t), "_b": boundary_strip(t, F.col(city)), "_k": coded(t), "_m": marked(t)}))
        entry = lambda text, how: F.struct(text.alias("t"), how.alias("how"))
        step = F.coalesce(
            F.when((F.col("_q") != "") & (F.col("_q") != t), entry(F.col("_q"), F.lit("CITY_QUALIFIED_NAME"))), F.when((F.col("_b") != "") & (F.col("_b") != t), entry(clean(F.col("_b")), F.lit("CITY_NAME"))),
            F.when(F.col("_k").isNotNull(), entry(clean(F.col("_k.t")), F.col("_k.how"))), F.when((F.col("_m") != "") & (F.col("_m") != t), entry(F.col("_m"), F.lit("CITY_QUALIFIER"))),
        )
        rows = rows.withColumn("_s", step).withColumns({"_t": F.coalesce("_s.t", "_t"), "_how": F.when(F.col("_s").isNotNull(), F.array_append("_how", F.col("_s.how"))).otherwise(F.col("_how"))})
    told = F.when(F.size("_how") > 0, F.concat(F.lit("CITY_PREFIX_CHAIN_"), F.array_join("_how", "+")))
    return rows.withColumn(out, F.struct(F.col("_t").alias("t"), told.alias("source"))).drop("_t", "_how", "_place", "_q", "_b", "_k", "_m", "_s")


def locality(stop: Column, city: Column) -> Column:
    """Whether what stands before "Bahnhof" is a place of its own."""
    n = c.plain(stop)
    words, raw = F.split(n, " "), F.split(stop, r"\s+")
    letters = lambda w: F.regexp_replace(w, r"[^\p{L}]", "")
    shape = stop.rlike(r"(?iu)^[\p{L}\p{N}][\p{L}\p{N}.'()-]*(?:\s+[\p{L}\p{N}][\p{L}\p{N}.'()-]*){0,3}$")
    capitals = F.exists(raw, lambda w: F.length(letters(w)).between(1, 3) & (w == F.upper(w)))
    other = F.exists(words, lambda w: (F.length(w) < 2) | w.rlike(STREET_ENDS) | w.isin(*NO_LOCALITY))
    return (n != "") & (F.length(letters(stop)) >= 3) & ~same(stop, city) & shape & ~capitals & ~other


def public_names(df: DataFrame, original: str, shown: str, aliases: DataFrame, official: str | None = None, city: str | None = None, station: str | None = None, rail: str | None = None) -> DataFrame:
    """``df`` with public_stop_name, public_city_name, public_display_name, public_quality, name_source and name_rules.

    ``official`` is the resolved city's column, ``aliases`` the codes of cities (as
    ``names.prefix_aliases`` gives them).
    """
    blank = F.lit("")
    rows = inferred(df, original, shown, city, station, rail)
    rows = rows.withColumn("_city", clean_city(F.col(official)) if official else blank)
    coded = aliases.groupBy("city").agg(F.collect_list(F.struct("code", "learned")).alias("_codes")).withColumnRenamed("city", "_key")
    rows = graph.spread(rows.withColumn("_key", c.plain(F.col("_city"))).join(coded, "_key", "left")).withColumn("_codes", F.coalesce("_codes", F.array().cast("array<struct<code:string,learned:boolean>>")))
    rows = rows.withColumn("_stop", F.col("_p.stop"))
    rows = graph.written(chained(chained(rows, "_stop", "_city", "_codes", "_i"), shown, "_city", "_codes", "_n"))
    town, stop, source = F.col("_city"), F.col("_p.stop"), F.col("_p.source")
    of = lambda x: clean_stop(F.col(x)["t"])
    good = lambda x: (of(x) != "") & ~same(of(x), town)
    entry = lambda s, how: F.struct(s.alias("stop"), town.alias("city"), how.alias("source"))
    kept = clean_stop(mode_free(F.col(shown)))
    twice = (F.size(F.split(c.plain(kept), " ")) > 1) & (F.get(F.split(c.plain(kept), " "), F.lit(0)) == F.get(F.split(c.plain(kept), " "), F.lit(1)))
    plain_stop = F.when((stop != "") & ~same(stop, F.col("_p.city")), stop).otherwise(kept)
    last = F.when((plain_stop != "") & ~same(plain_stop, town), plain_stop).otherwise(stop)
    resolved = F.coalesce(
        F.when(says_station(stop) & same(F.col("_p.city"), town) & good("_i"), entry(of("_i"), F.coalesce("_i.source", source))),
        F.when(F.col("_n.source").isNotNull() & good("_n"), entry(of("_n"), F.col("_n.source"))), F.when(F.col("_i.source").isNotNull() & good("_i"), entry(of("_i"), F.col("_i.source"))),
        F.when((source == "LEADING_CITY_GENERIC") & ~same(F.col("_p.city"), town) & (kept != "") & ~same(kept, town) & ~twice, entry(kept, F.lit("RESOLVED_CITY_LOCALITY_PRESERVED"))),
        F.when((last != "") & ~same(last, town), entry(last, source)),
    )
    rows = rows.withColumn("_f", F.when((source == "NAMED_FACILITY") | (town == ""), F.col("_p")).otherwise(F.coalesce(resolved.cast(PARTS), F.col("_p"))))
    rows = graph.written(rows)
    before = clean_stop(F.regexp_extract("_f.stop", r"(?iu)^(.+?)\s+Bahnhof$", 1))
    street = any_of([F.coalesce(F.col(x), blank).rlike("(?iu)" + STREET) for x in {original, shown}])
    suffix = (F.col("_f.city") != "") & (before != "") & ~street & locality(before, F.col("_f.city"))
    rows = rows.withColumns({"public_stop_name": F.when(suffix, before).otherwise(F.col("_f.stop")), "public_city_name": F.col("_f.city"), "name_source": F.when(suffix, F.concat("_f.source", F.lit("+GENERIC_STATION_SUFFIX_REMOVED"))).otherwise(F.col("_f.source"))})
    pair = F.when(F.col("public_city_name") == "", F.col("public_stop_name")).otherwise(F.concat("public_stop_name", F.lit(", "), "public_city_name"))
    rows = rows.withColumns({"public_display_name": F.when(F.col("public_stop_name") == "", F.coalesce(F.col(shown), blank)).otherwise(pair), "public_quality": F.when((F.col("public_stop_name") == "") | (F.col("public_city_name") == ""), "TECHNICAL").otherwise("GOOD")})
    rows = graph.written(rows)
    either = lambda test: test(F.coalesce(F.col(original), blank)) | test(F.coalesce(F.col(shown), blank))
    s = F.col("name_source")
    code = "|".join(k for k in names.CODES if k != names.WORD_CODE)
    known = {
        "CITY_FROM_RESOLVED_CONTEXT": town != "", "CITY_CODE_EXPANDED": s.contains("LEADING_CITY_CODE") | either(lambda x: clean(x).rlike(f"(?i)^(?:{code})[- ]")),
        "CITY_PREFIX_REMOVED": s.contains("LEADING_CITY_CODE") | either(lambda x: clean(x).rlike(f"(?i)^(?:{code})[- ]")) | s.contains("CITY_PREFIX_CHAIN") | s.contains("CITY_NAME"),
        "CITY_QUALIFIER_REMOVED": s.contains("CITY_QUALIFIER") | s.contains("CITY_QUALIFIED_NAME"), "MODE_PREFIX_REMOVED": either(lambda x: mode_free(x) != clean(x)), "TECHNICAL_QUALIFIER_REMOVED": either(lambda x: x.rlike("(?iu)" + LEVEL)),
        "STATION_ABBREVIATION_EXPANDED": either(lambda x: x.rlike(r"(?iu)(?<!\p{L})(?:hbf|bf|bhf)\.?(?!\p{L})")), "GENERIC_STATION_SUFFIX_REMOVED": s.contains("GENERIC_STATION_SUFFIX_REMOVED"),
        "STREET_SUFFIX_NORMALIZED": either(lambda x: streets(clean(x)) != clean(x)), "LOCALITY_COMPOUND_PRESERVED": s.contains("RESOLVED_CITY_LOCALITY_PRESERVED"), "STOP_CITY_COMPOSED": F.col("public_city_name") != "",
    }
    codes = F.array_compact(F.array(*[F.when(test, F.lit(k)) for k, test in known.items()]))
    return rows.withColumn("name_rules", names.encode_rules(codes)).drop("_p", "_f", "_i", "_n", "_stop", "_city", "_key", "_codes")


def display_names(areas: DataFrame, family: DataFrame, family_names: DataFrame, cities: DataFrame) -> DataFrame:
    """Public names of all areas: primaries by their family's name, other areas by their own."""
    named = areas.select("area_id", F.col("area_name").alias("name")).join(cities.select("area_id", F.col("city_name").alias("city")), "area_id", "left")
    aliases = names.prefix_aliases(named)
    kept = ["area_id", "canonical_area_id", "public_stop_name", "public_city_name", "public_display_name", "public_quality", "name_source", "name_rules"]
    heads = family_names.select("canonical_area_id", F.col("primary_area_id").alias("area_id"), "original_name", F.col("display_name").alias("shown"), "city_name", "station_name", "has_rail_service").join(named.select("area_id", "city"), "area_id", "left")
    first = public_names(heads, "original_name", "shown", aliases, "city", "city_name", "station_name", "has_rail_service").select(*kept)
    rest = named.join(heads.select("area_id"), "area_id", "left_anti").join(family.select("area_id", "canonical_area_id"), "area_id", "left").withColumn("canonical_area_id", F.coalesce("canonical_area_id", "area_id"))
    return first.union(public_names(rest, "name", "name", aliases, "city").select(*kept))


def name_audit(named: DataFrame, aliases: DataFrame, key: str = "area_id") -> DataFrame:
    """One row of counters over public names (unique in ``key``): what still names its city, in which way, and lists of rules that aren't valid."""
    stop, city, shown, rules = (F.coalesce(F.col(x), F.lit("")) for x in ("public_stop_name", "public_city_name", "public_display_name", "name_rules"))
    rows = names.without_prefix(named, aliases, key, "public_stop_name", "public_city_name").withColumns({"_s": spaced(stop), "_c": spaced(city)}).withColumns({"_n": c.plain(F.col("_s")), "_p": c.plain(F.col("_c"))})
    both, place = (F.col("_s") != "") & (F.col("_c") != ""), F.col("_p")
    mark = c.plain(F.regexp_extract("_s", r"^\(([^)]+)\)\s+(.+)$", 1))
    only = (place != "") & (F.col("_n") == place)
    stripped = F.col("prefix_source") != "NONE"
    code = F.upper(F.regexp_extract("_s", r"^(\p{Lu}{2,5})[-.]+.+$", 1))
    count = lambda test: F.count_if(both & F.coalesce(test, F.lit(False)))
    return rows.agg(
        F.count_if(both).alias("scanned"), count(spaced(shown) != F.concat("_s", F.lit(", "), "_c")).alias("format_mismatches"), count(only).alias("municipality_only"),
        count(~only & (place != "") & F.col("_n").startswith(F.concat(place, F.lit(" ")))).alias("duplicate_city"), count(stripped).alias("city_codes"),
        count((F.length(mark) >= 3) & F.contains(F.concat(F.lit(" "), place, F.lit(" ")), F.concat(F.lit(" "), mark, F.lit(" ")))).alias("city_qualifiers"),
        count((code != "") & ~code.isin(*names.MODES) & ~stripped).alias("unknown_prefixes"), F.count_if(names.rules_valid(rules) & (rules != "NONE")).alias("transformed"), F.count_if(~names.rules_valid(rules)).alias("invalid_rules"),
    )


def name_findings(named: DataFrame, originals: DataFrame, aliases: DataFrame, key: str = "area_id") -> DataFrame:
    """area_id, finding_type, classification, prefix and action of names that are their city's only, or begin with an abbreviation that no code explains."""
    rows = names.without_prefix(named, aliases, key, "public_stop_name", "public_city_name").join(originals.select(key, F.col("area_name").alias("_o")), key, "left")
    stop, city, own = (spaced(F.coalesce(F.col(x), F.lit(""))) for x in ("public_stop_name", "public_city_name", "_o"))
    code = F.upper(F.regexp_extract(stop, r"^(\p{Lu}{2,5})[-.]+(.+)$", 1))
    entry = lambda kind, what, prefix: F.struct(F.lit(kind).alias("finding_type"), what.alias("classification"), prefix.alias("prefix"), F.lit("PRESERVE").alias("action"))
    only = F.when(same(stop, city), entry("MUNICIPALITY_ONLY", F.when(own.contains("(") & own.contains(")"), "LOCALITY_STOP_WITH_SOURCE_QUALIFIER").otherwise("LOCALITY_STOP_NAME"), F.lit("")))
    prefixed = F.when((code != "") & ~code.isin(*names.MODES) & (F.col("prefix_source") == "NONE"), entry("UPPERCASE_PREFIX", names.prefix_class(code, city), code))
    return rows.filter((stop != "") & (city != "")).select(key, F.inline(F.array_compact(F.array(only, prefixed))))
