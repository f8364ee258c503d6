"""Names of stops: display forms, cities, aliases, codes before names. Column rules; nothing here leaves the JVM but the folding of compatibility forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from . import graph

# --- fixed values of the contract: codes, word lists and limits ---
#: Codes of what a public name went through, in the order in which they are written; NONE stands for no code.
RULES = (
    "CITY_FROM_RESOLVED_CONTEXT", "CITY_CODE_EXPANDED", "CITY_PREFIX_REMOVED", "CITY_QUALIFIER_REMOVED", "MODE_PREFIX_REMOVED", "TECHNICAL_QUALIFIER_REMOVED", "STATION_ABBREVIATION_EXPANDED",
    "GENERIC_STATION_SUFFIX_REMOVED", "STREET_SUFFIX_NORMALIZED", "LOCALITY_COMPOUND_PRESERVED", "STOP_CITY_COMPOSED",
)
#: Prefixes in capitals that are no city's code.
PREFIXES = {
    "INSTITUTION_NAME": ["HEIG", "UNIL", "KIT", "HAWK", "TU", "DFB", "LWL", "LVR"],
    "TRANSIT_OR_INFRASTRUCTURE_TERM": ["AST", "BAB", "BSAG", "GVZ", "KVG", "OEG", "RVE", "RVK", "SBB", "SSB", "ZUP"],
    "NAMED_ENTITY": ["AOK", "ASB", "AWO", "BMW", "BRK", "DRK", "EDEKA", "ERGO", "JVA", "REWE", "SAP", "VW"],
    "SECTION_OR_ZONE_LABEL": ["II", "III", "IV", "VI", "VII", "VIII", "IX"],
}
MODES = ["S", "U", "SU", "BUS", "TRAM"]
#: Cities of codes that need no learning.
CODES = {
    "D": "Düsseldorf", "DO": "Dortmund", "DU": "Duisburg", "E": "Essen", "FFM": "Frankfurt am Main", "MG": "Mönchengladbach", "OB": "Oberhausen", "SZ": "Salzgitter", "AB": "Aschaffenburg", "PB": "Paderborn", "GD": "Schwäbisch Gmünd",
    "FRANKFURT": "Frankfurt am Main",
}
#: The code that may be written in small letters.
WORD_CODE = "FRANKFURT"
#: Words at which the city in a name ends.
STOP_WORDS = ["hbf", "hauptbahnhof", "bahnhof", "bf", "zob", "bus", "str", "strasse", "kaiserstrasse", "bahnhofstrasse", "platz", "kirchenallee", "steintordamm", "nord", "sued", "sud", "ost", "west"]
#: Parts of names that only staff use, and words of that kind.
TECHNICAL_PARTS, TECHNICAL_WORDS = ["kaiserstrasse", "bahnhofstrasse", "kirchenallee", "steintordamm", "zob", "bus"], ["str", "strasse"]
STREET_PARTS = ["bahnhofstr", "kaiserstr", "kirchenallee", "steintordamm", "zob", "bus"]
MODE_PREFIX = r"(?i)^(?:s\+u|s u|s\+u-bahnhof|s-bahnhof|u-bahnhof|s|u)\s+"
STATION_WORDS = ["hbf", "hauptbahnhof", "bahnhof", "bf", "stadtbahnhof"]
SUPPORT, DOMINANCE, PREFIX_CHARS, CODE_CHARS = 20, 0.98, 14, 10
# --- end of fixed values ---


def any_of(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def station_words(normal: Column) -> Column:
    """Whether a search form says station."""
    return c.contains_token(normal, "hbf") | c.contains_token(normal, "bf") | normal.contains("bahnhof")


def first_filled(*options: Column) -> Column:
    """The first that is not blank, else the empty text."""
    return F.coalesce(*[F.when(F.trim(x) != "", x) for x in options], F.lit(""))


def spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def station_form(text: Column) -> Column:
    """Main stations in their short form, station streets spelled out."""
    out = text
    for a, b in (("Hauptbahnhof", "Hbf"), ("hauptbahnhof", "Hbf"), ("HBF", "Hbf"), ("Bahnhofstr.", "Bahnhofstrasse"), ("Bahnhofstraße", "Bahnhofstrasse")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return spaced(out)


def clean_display(name: Column) -> Column:
    """Without what is in parentheses, '/' and ',' as spaces, stations in their short form."""
    bare = F.regexp_replace(F.coalesce(name, F.lit("")), r"\s*\([^)]*\)", "")
    return station_form(spaced(F.regexp_replace(bare, "[/,]", " ")))


def without_mode(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, MODE_PREFIX, ""))


def city_name(name: Column) -> Column:
    """The city in a name: what stands before a comma (behind it, if a station stands before), else the words up to one that is no city's."""
    bare = F.trim(F.regexp_replace(F.coalesce(name, F.lit("")), r"\s*\([^)]*\)", ""))
    at = F.locate(",", bare)
    left, right = clean_display(F.substring(bare, F.lit(1), at - 1)), without_mode(clean_display(F.substring(bare, at + 1, F.length(bare))))
    of_comma = F.when(station_words(c.plain(left)) & (right != ""), right).otherwise(left)
    words = F.split(without_mode(clean_display(bare)), " ")

    def ends(word: Column) -> Column:
        n = c.plain(word)
        return (n == "") | n.isin(*STOP_WORDS) | n.contains("bf")

    first_end = F.array_position(F.transform(words, ends), True).cast("int")
    of_words = F.array_join(F.when(first_end == 0, words).otherwise(F.slice(words, F.lit(1), F.greatest(first_end - 1, F.lit(0)))), " ")
    behind = F.array_join(F.slice(words, F.lit(2), F.size(words)), " ")
    plain_name = F.when((F.size(words) > 1) & station_words(c.plain(F.get(words, F.lit(0)))), behind).otherwise(of_words)
    return F.trim(F.when(at > 1, of_comma).otherwise(plain_name))


def station_name(name: Column, city: Column) -> Column:
    """The display form without the city at its beginning, where a word ends there."""
    shown = without_mode(clean_display(name))
    n = F.length(city)
    leads = (F.trim(city) != "") & (F.lower(F.substring(shown, F.lit(1), n)) == F.lower(city)) & ((F.length(shown) == n) | F.substring(shown, n + 1, F.lit(1)).rlike(r"[\s,/\-.(]"))
    rest = F.trim(F.substring(shown, n + 1, F.length(shown)))
    return F.when(leads, F.regexp_replace(rest, r"^\.\s*", "")).otherwise(shown)


def technical(normal: Column) -> Column:
    return any_of([normal.contains(p) for p in TECHNICAL_PARTS] + [c.contains_token(normal, w) for w in TECHNICAL_WORDS])


def street_or_bus(normal: Column) -> Column:
    return any_of([normal.contains(p) for p in STREET_PARTS] + [c.contains_token(normal, w) for w in TECHNICAL_WORDS])


def display_quality(name: Column) -> Column:
    """TECHNICAL for blank names and those that only staff use, else GOOD; of the contract's third value, for buses, all are technical already."""
    n = c.normalised(name)
    return F.when(F.trim(F.coalesce(name, F.lit(""))) == "", "TECHNICAL").when(technical(n), "TECHNICAL").when(n.contains("zob") | n.contains("bus"), "AVOID_FOR_USER").otherwise("GOOD")


def city_station(city: Column, normal: Column) -> Column:
    """The city with the kind of station that a search form names; blank without a city."""
    kind = F.when(c.contains_token(normal, "hbf") | normal.contains("hauptbahnhof"), "Hbf")
    for word, shown in (("ostbahnhof", "Ostbahnhof"), ("westbahnhof", "Westbahnhof"), ("nordbahnhof", "Nordbahnhof"), ("suedbahnhof", "Suedbahnhof"), ("sudbahnhof", "Suedbahnhof")):
        kind = kind.when(normal.contains(word), shown)
    return F.when(F.trim(city) == "", "").otherwise(F.concat(city, F.lit(" "), kind.otherwise("Bahnhof")))


def harmonised(df: DataFrame, name: str, station: str, preferred: str | None = None, official: str | None = None) -> DataFrame:
    """``df`` with display_name, city_name, station_name, name_order and display_quality of ``name``; ``station`` says whether it belongs to a station.

    A station's street or bus name gives way to its city and kind; a main station is
    named by its city.
    """
    blank = F.lit("")
    own = F.trim(F.coalesce(F.col(name), blank))
    want = F.coalesce(F.col(preferred), blank) if preferred else blank
    out = df.withColumns({"_own": own, "_shown": clean_display(first_filled(want, own))})
    out = out.withColumns({"_n": c.plain(F.col("_own")), "_c": c.plain(F.col("_shown")), "_city": first_filled(city_name(F.col("_own")), city_name(F.col("_shown")))})
    n, shown, city = F.col("_n"), F.col("_shown"), F.col("_city")
    main = c.contains_token(n, "hbf") | n.contains("hauptbahnhof")
    picked = (
        F.when(F.col(station) & (technical(F.col("_c")) | (shown == "")), city_station(city, n))
        .when(F.col(station) & (city != "") & main & ~c.contains_token(F.col("_c"), "hbf"), F.concat(city, F.lit(" Hbf")))
        .when(F.col(station) & street_or_bus(F.col("_c")), city_station(city, n)).otherwise(shown)
    )
    out = out.withColumn("display_name", first_filled(station_form(picked), clean_display(F.col("_own"))))
    given = clean_display(F.col(official)) if official else blank
    out = out.withColumn("city_name", first_filled(given, city_name(F.col("display_name"))))
    out = out.withColumns({"station_name": station_name(F.col("display_name"), F.col("city_name")), "name_order": F.when(F.col("city_name") == "", "STATION_ONLY").otherwise("CITY_STATION"), "display_quality": display_quality(F.col("display_name"))})
    return out.drop("_own", "_shown", "_n", "_c", "_city")


def encode_rules(rules: Column) -> Column:
    """Codes in their order, joined by bars; an unknown code raises."""
    known = F.array(*map(F.lit, RULES))
    unknown = F.array_except(rules, F.array(*map(F.lit, (*RULES, "NONE"))))
    written = F.array_join(F.array_intersect(known, rules), "|")
    return F.when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("unknown rules: "), F.array_join(unknown, ", "))).cast("string")).when(written == "", "NONE").otherwise(written)


def rules_valid(text: Column) -> Column:
    """Whether a written list is NONE or known codes, each once and in their order."""
    parts = F.split(text, r"\|")
    return F.coalesce((text == "NONE") | (F.array_join(F.array_intersect(F.array(*map(F.lit, RULES)), parts), "|") == text) & (text != ""), F.lit(False))


def rules_of(explanation: Column) -> Column:
    """The written list in an explanation; blank if it has none."""
    return F.trim(F.regexp_extract(F.coalesce(explanation, F.lit("")), r"(?:^|;\s*)rules=([^;]+)", 1))


def in_order(code: Column, text: Column) -> Column:
    """Whether the letters of a code come in a text in this order."""
    pattern = F.array_join(F.transform(F.split(code, ""), lambda x: x), ".*")
    return F.regexp_like(text, pattern)


def prefix_class(prefix: Column, city: Column) -> Column:
    """What a prefix in capitals is: of a fixed list, maybe a city's code, or an abbreviation to keep."""
    code = F.upper(spaced(F.coalesce(prefix, F.lit(""))))
    place = F.upper(F.regexp_replace(c.normalised(city), "[^a-z0-9]", ""))
    out = None
    for kind, codes in PREFIXES.items():
        out = F.when(code.isin(*codes), kind) if out is None else out.when(code.isin(*codes), kind)
    safe = F.regexp_replace(code, "[^\\p{L}0-9]", "")
    return out.when((F.length(code) >= 2) & (place != "") & (safe == code) & in_order(safe, place), "LOCALITY_CODE_CANDIDATE").otherwise("PRESERVED_ACRONYM")


def prefix_code(text: Column) -> Column:
    return F.upper(F.regexp_replace(text, "[^\\p{L}]", ""))


def prefix_shape(text: Column) -> Column:
    """Whether a prefix is capitals with dots and dashes, of CODE_CHARS characters at most."""
    return (F.length(text) <= CODE_CHARS) & text.rlike("^[\\p{Lu}.-]*\\p{Lu}[\\p{Lu}.-]*$")


def prefix_aliases(named: DataFrame, name: str = "name", city: str = "city") -> DataFrame:
    """code, city (in search form) and learned: fixed codes, what cities' names give (first two letters, initials), and codes before a dash that nearly always stand for one city."""
    spark = named.sparkSession
    place = c.normalised(F.col(city))
    rows = named.select(spaced(F.coalesce(F.col(name), F.lit(""))).alias("name"), place.alias("city")).filter("city <> ''")
    fixed = spark.createDataFrame(list(CODES.items()), "code string, city string").select("code", c.normalised(F.col("city")).alias("city"))
    cities = rows.select("city").distinct()
    compact, words = F.replace(F.col("city"), F.lit(" "), F.lit("")), F.split("city", " ")
    pair = cities.filter(F.length(compact) >= 2).select(F.upper(F.substring(compact, 1, 2)).alias("code"), "city")
    initials = cities.filter(F.size(words) >= 2).select(F.upper(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")).alias("code"), "city")
    known = fixed.union(pair).union(initials).distinct().withColumn("learned", F.lit(False))
    at = F.locate("-", F.col("name"))
    head = F.trim(F.substring(F.col("name"), F.lit(1), at - 1))
    seen = rows.filter((at > 1) & (at <= 7) & prefix_shape(head)).select(prefix_code(head).alias("code"), "city").filter((F.length("code") >= 2) & ~F.col("code").isin(*MODES))
    counts = seen.groupBy("code", "city").agg(F.count("*").alias("n"))
    best = counts.groupBy("code").agg(F.sum("n").alias("total"), F.max_by("city", F.struct(F.col("n"), F.col("city"))).alias("city"), F.max("n").alias("n"))
    learned = best.filter((F.col("n") >= SUPPORT) & (F.col("n") >= F.col("total") * DOMINANCE) & in_order(F.col("code"), F.upper(compact))).select("code", "city")
    return known.union(learned.join(known, ["code", "city"], "left_anti").withColumn("learned", F.lit(True)))


def without_prefix(df: DataFrame, aliases: DataFrame, key: str, name: str, city: str) -> DataFrame:
    """``df`` (unique in ``key``) with stripped_name, stripped_prefix and prefix_source: the longest prefix before a dash or the first space that stands for the city goes."""
    text = spaced(F.coalesce(F.col(name), F.lit("")))
    rows = df.select(key, text.alias("_t"), c.normalised(F.col(city)).alias("_city"))
    limit = F.least(F.length("_t"), F.lit(PREFIX_CHARS))
    dashes = F.filter(F.sequence(F.lit(1), F.greatest(limit, F.lit(1))), lambda k: F.substring(F.col("_t"), k, F.lit(1)) == "-")
    space = F.locate(" ", F.col("_t"))
    # a space counts behind the last dash that counts: the longer prefix wins
    places = F.concat(dashes, F.when((space > 1) & (space <= limit), F.array(space)).otherwise(F.array().cast("array<int>")))
    cut = rows.select(key, "_city", "_t", F.explode(places).alias("_at")).select(key, F.col("_city").alias("city"), "_at", F.trim(F.substring(F.col("_t"), F.lit(1), F.col("_at") - 1)).alias("_p"), F.trim(F.substring(F.col("_t"), F.col("_at") + 1, F.length("_t"))).alias("_rest"))
    cut = cut.withColumn("code", prefix_code(F.col("_p"))).filter((F.col("_rest") != "") & (F.col("code") != "") & (prefix_shape(F.col("_p")) | (F.col("code") == WORD_CODE)))
    best = cut.join(aliases, ["code", "city"]).groupBy(key).agg(F.max_by(F.struct(F.col("_rest").alias("r"), F.col("_p").alias("p"), "learned"), "_at").alias("_x"))
    out = df.join(best, key, "left")
    source = F.when(F.col("_x").isNull(), "NONE").when(F.col("_x.learned"), "LEARNED").otherwise("CURATED_OR_DERIVED")
    return out.withColumns({"stripped_name": F.coalesce("_x.r", text), "stripped_prefix": F.coalesce("_x.p", F.lit("")), "prefix_source": source}).drop("_x")


def region_stripped(city: Column) -> Column:
    return F.when(city.endswith(" bodensee"), F.trim(F.regexp_replace(city, " bodensee$", ""))).otherwise(F.regexp_replace(city, "(?<=.) (?:bay|main|westf)$", ""))


def city_candidate(normal: Column) -> Column:
    """The city in a search form: what stands before a station word, without a region behind it."""
    out = normal
    for word in ("stadtbahnhof", "hauptbahnhof", "hbf", "bahnhof", "bf", "zob"):
        out = F.regexp_replace(out, rf"\s+{word}.*$", "")
    out = F.trim(F.regexp_replace(F.trim(out), " aller.*$", ""))
    return F.regexp_replace(out, "(?<=.) (?:bay|main|westf)$", "")


def trailing_city(words: Column, start: Column) -> Column:
    """The words from a place on up to a station word."""
    rest = F.slice(words, start, F.size(words))
    end = F.array_position(F.transform(rest, lambda w: w.isin(*STATION_WORDS, "zob")), True).cast("int")
    return F.array_join(F.when(end == 0, rest).otherwise(F.slice(rest, F.lit(1), F.greatest(end - 1, F.lit(0)))), " ")


def _alias_list(n: Column, base: Column) -> Column:
    """All aliases (alias_normalized, alias_type, priority) of a name in search form."""
    one = lambda text, kind, less: F.struct(text.alias("t"), F.lit(kind).alias("k"), (base - less).alias("p"))
    given = lambda test, *items: F.when(test, F.array(*items)).otherwise(F.array().cast("array<struct<t:string,k:string,p:int>>"))
    has = lambda word: c.contains_token(n, word)
    swap = lambda a, b: F.replace(F.replace(n, F.lit(f" {a}"), F.lit(f" {b}")), F.lit(f"{a} "), F.lit(f"{b} "))
    put = lambda a, b: F.replace(n, F.lit(a), F.lit(b))
    main = has("hbf") | n.contains("hauptbahnhof")
    city = city_candidate(n)
    is_city = (city != "") & ~station_words(city) & station_words(n)
    with_station = lambda x, less: [one(F.concat(x, F.lit(w)), "RAIL_STATION_INTENT", less) for w in (" bahnhof", " bf")]
    with_main = lambda x, less: [one(F.concat(x, F.lit(w)), "RAIL_STATION_INTENT", less) for w in (" hbf", " hauptbahnhof")]
    words = F.split(n, " ")

    def behind(k: Column) -> Column:
        """Aliases from a city that stands behind the station word at place k."""
        word, far = F.get(words, k - 1), trailing_city(words, k + 1)
        near = region_stripped(far)
        good = (far != "") & ~c.contains_token(far, "bahnhof") & ~c.contains_token(far, "bf") & word.isin(*STATION_WORDS)
        twice, of_main = good & (near != far) & (near != ""), word.isin("hbf", "hauptbahnhof")
        return F.concat(given(good, *with_station(far, 20)), given(twice, *with_station(near, 20)), given(good & of_main, *with_main(far, 20)), given(twice & of_main, *with_main(near, 20)))

    stripped = F.regexp_replace(n, "^(?:s und u|s u|s|u) ", "")
    return F.concat(
        F.array(one(n, "CANONICAL", 0)),
        given(has("hbf"), one(swap("hbf", "hauptbahnhof"), "STATION_SYNONYM", 10)), given(n.contains("hauptbahnhof"), one(put("hauptbahnhof", "hbf"), "STATION_SYNONYM", 10)),
        given(has("bf"), one(swap("bf", "bahnhof"), "STATION_SYNONYM", 10)), given(n.contains("bahnhof"), one(put("bahnhof", "bf"), "STATION_SYNONYM", 10)),
        given(n.contains("stadtbahnhof"), *[one(put("stadtbahnhof", w), "RAIL_STATION_INTENT", 10) for w in ("bahnhof", "bf")]),
        given(is_city, *with_station(city, 15)), given(is_city & main, *with_main(city, 15)),
        F.when(is_city & (F.size(words) > 1), F.flatten(F.transform(F.sequence(F.lit(1), F.size(words) - 1), behind))).otherwise(F.array().cast("array<struct<t:string,k:string,p:int>>")),
        given((stripped != "") & (stripped != n) & ~stripped.rlike("^(?:s und u|s u|s|u)$"), one(stripped, "MODE_PREFIX_STRIPPED", 20)),
        given(n.endswith(" bf"), one(F.trim(F.regexp_replace(n, " bf$", "")), "STATION_SUFFIX_STRIPPED", 30)),
        given(n.endswith(" bahnhof"), one(F.trim(F.regexp_replace(n, " bahnhof$", "")), "STATION_SUFFIX_STRIPPED", 30)),
    )


def aliases(areas: DataFrame, stops: DataFrame, cities: DataFrame | None = None) -> DataFrame:
    """area_id, alias, alias_normalized, alias_type, source and priority: names of areas and of their stops, other words for stations, names without mode, station or with the city.

    Streets' short endings are spelled out as well.  Of equal aliases of one type and
    source the one with the highest priority, then the smallest text, counts.
    """
    own = areas.select("area_id", F.col("area_name").alias("name"), F.lit("AREA_NAME").alias("source"), F.lit(100).alias("base"))
    named = own.union(stops.select(c.area_id(F.col("parent_station"), F.col("stop_id")), "stop_name", F.lit("STOP_NAME"), F.lit(70)))
    rows = graph.spread(named).withColumn("n", c.normalised(F.col("name"))).filter("n <> ''")
    listed = rows.select("area_id", "source", "name", "n", F.explode(_alias_list(F.col("n"), F.col("base"))).alias("x"))
    listed = listed.select("area_id", "source", F.when(F.col("x.k") == "CANONICAL", c.trimmed(F.col("name"))).otherwise(spaced(F.col("x.t"))).alias("alias"), spaced(F.col("x.t")).alias("alias_normalized"), F.col("x.k").alias("alias_type"), F.col("x.p").alias("priority"))
    if cities is not None:
        of_city = rows.join(cities.select("area_id", c.normalised(F.col("city_name")).alias("city")), "area_id").filter("city <> '' AND n <> city AND NOT startswith(n, city || ' ')")
        both = F.concat("city", F.lit(" "), "n")
        listed = listed.union(of_city.select("area_id", "source", both, both, F.lit("CITY_QUALIFIED"), (F.col("base") - 5)))
    long = F.array_join(F.transform(F.split("alias_normalized", " "), lambda w: F.when((F.length(w) > 3) & w.endswith("str"), F.concat(w, F.lit("asse"))).otherwise(w)), " ")
    streets = listed.withColumn("_long", long).filter("_long <> alias_normalized").select("area_id", "source", F.col("_long").alias("alias"), F.col("_long").alias("alias_normalized"), "alias_type", "priority")
    every = listed.union(streets).filter("alias_normalized <> ''")
    best = every.groupBy("area_id", "alias_normalized", "alias_type", "source").agg(F.min(F.struct((-F.col("priority")).alias("p"), "alias")).alias("x"))
    return best.select("area_id", F.col("x.alias").alias("alias"), "alias_normalized", "alias_type", "source", (-F.col("x.p")).alias("priority"))


def meaningful(normal: Column) -> Column:
    """Words of three letters or more that tell a place, up to a district's mark."""
    bare = spaced(F.regexp_replace(normal, r"\b(?:krs|kreis|landkreis|kr)\b.*", ""))
    stop = [w for w in STOP_WORDS if w != "bf"]
    return F.filter(F.split(bare, " "), lambda w: (F.length(w) >= 3) & ~w.isin(*stop))


def base_key(text: Column) -> Column:
    """A search form without its station words and what is behind them."""
    out = F.regexp_replace(text, r"\b(?:krs|kreis|landkreis|kr)\b.*", "")
    for word in ("bahnhof", "bf", "hauptbahnhof", "hbf"):
        out = F.regexp_replace(out, rf"\b{word}\b.*", "")
    return spaced(out)


def generic_station(name: Column) -> Column:
    """Whether a name is no more than a city's, or its station's."""
    city = c.plain(city_name(name))
    n = spaced(F.regexp_replace(c.plain(name), r"\b(?:krs|kreis|landkreis|kr)\b.*", ""))
    return (city != "") & any_of([n == F.concat(city, F.lit(w)) for w in ("", " bahnhof", " bf", " hbf", " hauptbahnhof")])


def technical_station(normal: Column, rail: Column) -> Column:
    """Whether a rail stop is named by its street."""
    return rail & any_of([normal.contains(p) for p in ("kaiserstr", "bahnhofstr", "kirchenallee", "steintordamm")] + [c.contains_token(normal, w) for w in TECHNICAL_WORDS])


def merge_key(name: Column, rail: Column) -> Column:
    """What stations of one city share if their names say no more than that; blank for others."""
    own = generic_station(name) | technical_station(c.plain(name), rail)
    return F.when(own, first_filled(base_key(c.plain(city_name(name))), base_key(c.plain(name)))).otherwise("")
