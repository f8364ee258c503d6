"""Station families: areas that passengers take for one station.

Areas with trains, subways or trams are primaries.  In order of rank each joins the
nearest family it may merge with, or the first family of its city's plain station
name, or begins a family.  That order matters only among primaries that could merge:
rounds of joins settle all that wait for none before them.  All else is joins: feeders
go to the first family in reach, other served areas stand alone, and names are picked
by scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from . import derive, graph, names

# --- fixed values of the contract: reach in metres, cells in degrees ---
FEEDER_METRES, PRIMARY_METRES, GENERIC_METRES, NAMED_METRES = 320, 450, 2500, 5000
CELL, WIDE_CELL = 0.005, 0.04
# --- end of fixed values ---
FLAGS = ["has_train", "has_rail_service", "has_subway", "has_tram", "bus_only", "station_name_signal", "main_station_signal"]


def candidates(areas: DataFrame, profiles: DataFrame) -> DataFrame:
    """Areas with their profiles and what decisions on them need; ``rank`` orders primaries."""
    own = profiles.select("area_id", *FLAGS, "search_priority_score", "route_count", "profile_class", "line_labels")
    rows = graph.spread(areas.select("area_id", "area_name", "area_lat", "area_lon").join(own, "area_id"))
    on = lambda x: F.col(x) == 1
    rail = on("has_rail_service")
    n = c.normalised(F.col("area_name"))
    out = rows.withColumn("n", n).withColumn("words", names.meaningful(F.col("n")))
    out = out.withColumn("generic", names.generic_station(F.col("area_name")))
    out = out.withColumn("technical", names.technical_station(F.col("n"), rail)).withColumn("base", names.base_key(c.plain(names.city_name(F.col("area_name")))))
    signal = on("station_name_signal") | on("main_station_signal") | (rail & F.col("generic")) | F.col("n").contains("hbf") | F.col("n").contains("bahnhof") | F.col("n").contains("zob")
    key = F.when(F.col("generic") | F.col("technical"), names.first_filled(F.col("base"), names.base_key(F.col("n")))).otherwise("")
    rank = F.struct((~on("has_train")).alias("no_train"), (~rail).alias("no_rail"), (~on("main_station_signal")).alias("no_main"), (-F.col("search_priority_score")).alias("minus_score"), "area_name", "area_id")
    return out.withColumns({"signal": signal, "merge_key": key, "is_primary": rail | on("has_subway") | on("has_tram"), "rank": rank})


#: What a decision on two areas looks at.
SIDE = ["words", "main_station_signal", "signal", "generic", "technical", "base", "area_lat", "area_lon", "has_rail_service", "has_train", "search_priority_score"]


def _side(rows: DataFrame, tag: str) -> DataFrame:
    return rows.select(*[F.col(x).alias(f"{tag}_{x}") for x in ("area_id", "rank", *SIDE)])


def same_place(a: str, b: str) -> Column:
    """Whether two areas share a word of their names, or are both main stations."""
    return F.arrays_overlap(F.col(f"{a}_words"), F.col(f"{b}_words")) | ((F.col(f"{a}_main_station_signal") == 1) & (F.col(f"{b}_main_station_signal") == 1))


def _special(a: str, b: str) -> Column:
    """Whether two names are the plain station of one city, or one of them is and the other is a rail stop named by its street."""
    g, t = (lambda x: F.col(f"{x}_generic")), (lambda x: F.col(f"{x}_technical"))
    return (g(a) & g(b) & (F.col(f"{a}_base") != "") & (F.col(f"{a}_base") == F.col(f"{b}_base"))) | (t(a) & g(b)) | (g(a) & t(b))


def outranks(a: str, b: str) -> Column:
    """Whether a rail area may take another in: both have rail, and it has trains that the other lacks, or no smaller score."""
    on = lambda side, x: F.col(f"{side}_{x}") == 1
    return on(a, "has_rail_service") & on(b, "has_rail_service") & ((on(a, "has_train") & ~on(b, "has_train")) | (F.col(f"{a}_search_priority_score") >= F.col(f"{b}_search_priority_score")))


def merge_links(primaries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """By what a primary may take in those behind it in rank: close places, words by which areas there are of one place, and links of pairs for their special names.

    Places (from_lat, from_lon, lat, lon, distance_meters) are within PRIMARY_METRES; a
    word (area_id, lat, lon, word, told) is one that several areas share, "" that an area
    is a main station, told its rank.  Two areas with a common word at close places are
    linked; they aren't paired, as a crowd has as many pairs as the square of its areas.
    Pairs (a, b, distance_meters) are those of equal plain names, and of a street's and a
    plain one, within GENERIC_METRES.
    """
    own = graph.written(primaries.filter(F.col("signal") & F.col("area_lat").isNotNull() & F.col("area_lon").isNotNull()).select("area_id", "rank", *SIDE))
    lat, lon = F.col("area_lat").alias("lat"), F.col("area_lon").alias("lon")
    close = derive.nearby_places(own.select(lat, lon).distinct(), WIDE_CELL, 1, PRIMARY_METRES)
    said = F.array_distinct(F.concat("words", F.when(F.col("main_station_signal") == 1, F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))))
    words = own.select("area_id", lat, lon, F.explode(said).alias("word"), F.col("rank").alias("told"))
    words = words.join(words.groupBy("word").count().filter("count > 1").select("word"), "word", "left_semi").select("area_id", "lat", "lon", "word", "told")
    cells = own.select("area_id", "base", lat, lon, "generic", "technical", c.cell(F.col("area_lat"), WIDE_CELL).alias("cy"), c.cell(F.col("area_lon"), WIDE_CELL).alias("cx"))
    steps = F.sequence(F.lit(-1), F.lit(1))
    spread = cells.withColumn("cy", F.explode(F.transform(steps, lambda d: F.col("cy") + d))).withColumn("cx", F.explode(F.transform(steps, lambda d: F.col("cx") + d)))
    side = lambda df, tag, *keys: df.select(*keys, *[F.col(x).alias(f"{tag}_{x}") for x in ("area_id", "lat", "lon")])
    equal = graph.block_join(*(side(df.filter("generic AND base <> ''"), tag, "base", "cy", "cx") for df, tag in ((spread, "x"), (cells, "y"))), ["base", "cy", "cx"]).drop("base")
    street = graph.block_join(side(spread.filter("technical"), "x", "cy", "cx"), side(cells.filter("generic"), "y", "cy", "cx"), ["cy", "cx"])
    apart = street.unionByName(equal).filter("x_area_id <> y_area_id").withColumn("distance_meters", c.metres(*[F.col(f"{t}_{x}") for t in "xy" for x in ("lat", "lon")])).filter(F.col("distance_meters") <= GENERIC_METRES)
    pairs = graph.written(apart.select(F.least("x_area_id", "y_area_id").alias("x"), F.greatest("x_area_id", "y_area_id").alias("y"), "distance_meters").distinct())
    both = pairs.select(F.col("x").alias("a_area_id"), F.col("y").alias("b_area_id"), "distance_meters").union(pairs.select("y", "x", "distance_meters"))
    met = both.join(_side(own, "a"), "a_area_id").join(_side(own, "b"), "b_area_id").filter(F.col("a_rank") < F.col("b_rank"))
    met = met.filter(same_place("a", "b") & _special("a", "b") & outranks("a", "b"))
    return close, words, met.select(F.col("a_area_id").alias("a"), F.col("b_area_id").alias("b"), "distance_meters")


def settle(primaries: DataFrame, links: tuple[DataFrame, DataFrame, DataFrame]) -> DataFrame:
    """head, area_id and distance_meters of primaries, as if each in order of rank joined a family before it or began one.

    A primary joins the nearest head that is linked to it (of two as near the first in
    rank), else the first head of its key if that fits and outranks it, else it begins a
    family; distance is null for heads.  Each round settles all primaries that wait for
    none before them: no linked one may still begin a family, and of its key a head comes
    before all that may.  The first in rank that may is always among them; all that are
    linked to a new head are members from then on, so a crowd takes two rounds, and only
    a chain of links in order of rank takes as many as it is long.  Primaries meet only
    heads, of which few share a word within reach of each other; whether any other comes
    before one is told by the first in rank of each word near its place.
    """
    own = ["area_id", "rank", "merge_key", *SIDE]
    pending, (close, words, links) = graph.written(primaries.select(*own)), map(graph.written, links)
    heads, out = pending.limit(0), primaries.select(F.col("area_id").alias("head"), "area_id", F.lit(None).cast("long").alias("distance_meters")).limit(0)
    while not pending.isEmpty():
        links = graph.written(links.join(pending.select(F.col("area_id").alias("b")), "b", "left_semi"))
        waiting = words.join(pending.select("area_id"), "area_id", "left_semi")
        around = lambda df, *rest: df.withColumnsRenamed({"lat": "from_lat", "lon": "from_lon"}).join(close, ["from_lat", "from_lon"]).select("lat", "lon", "word", *rest)
        of_words = around(words.join(heads.select("area_id"), "area_id", "left_semi"), F.struct("distance_meters", F.col("told").alias("rank"), F.col("area_id").alias("head")).alias("at"))
        of_words = waiting.join(of_words, ["lat", "lon", "word"]).filter(F.col("at.rank") < F.col("told")).select("area_id", "at")
        of_pairs = links.join(heads.select(F.col("area_id").alias("a"), "rank"), "a").select(F.col("b").alias("area_id"), F.struct("distance_meters", "rank", F.col("a").alias("head")).alias("at"))
        nearest = of_words.union(of_pairs).groupBy("area_id").agg(F.min("at").alias("nearest"))
        seen = graph.written(pending.join(nearest, "area_id", "left"))
        # who has a head in reach will never be one, so none waits for it
        maybe = seen.filter("nearest IS NULL")
        firsts = words.join(maybe.select("area_id"), "area_id", "left_semi").groupBy("lat", "lon", "word").agg(F.min("told").alias("least"))
        firsts = around(firsts, "least").groupBy("lat", "lon", "word").agg(F.min("least").alias("least"))
        blocked = waiting.join(firsts, ["lat", "lon", "word"]).filter(F.col("least") < F.col("told")).select("area_id")
        blocked = blocked.union(links.join(maybe.select(F.col("area_id").alias("a")), "a", "left_semi").select(F.col("b").alias("area_id"))).distinct()
        first = heads.filter("merge_key <> ''").groupBy("merge_key").agg(F.min_by(F.struct(*[x for x in own if x != "merge_key"]), "rank").alias("first"))
        waits = maybe.filter("merge_key <> ''").groupBy("merge_key").agg(F.min("rank").alias("waits"))
        rows = seen.join(blocked, "area_id", "left_anti").join(first, "merge_key", "left").join(waits, "merge_key", "left")
        near, known, rank = F.col("nearest").isNotNull(), F.col("first.rank"), F.col("rank")
        ready = near | (F.col("merge_key") == "") | (F.col("waits") == rank) | F.coalesce(known < F.col("waits"), F.lit(False))
        rows = rows.filter(ready).withColumns({f"{t}_{x}": F.col(f"first.{x}") if t == "a" else F.col(x) for t in "ab" for x in SIDE})
        metres = c.metres(*[F.col(f"{t}_area_{x}") for t in "ab" for x in ("lat", "lon")])
        fits = same_place("a", "b") & F.col("a_signal") & F.col("b_signal") & _special("a", "b") & (metres.isNull() | (metres <= NAMED_METRES)) & outranks("a", "b")
        named = F.coalesce((known < rank) & fits, F.lit(False))
        head = F.when(near, F.col("nearest.head")).when(named, F.col("first.area_id")).otherwise(F.col("area_id"))
        away = F.when(near, F.col("nearest.distance_meters")).when(named, F.coalesce(metres, F.lit(NAMED_METRES)))
        new = graph.written(rows.select(*own, head.alias("head"), away.cast("long").alias("distance_meters")))
        out = out.union(new.select("head", "area_id", "distance_meters"))
        heads = graph.written(heads.union(new.filter("head = area_id").select(*own)))
        pending = graph.written(pending.join(new.select("area_id"), "area_id", "left_anti"))
    return out


def merged_primaries(rows: DataFrame) -> DataFrame:
    """head, area_id and distance_meters of all primaries."""
    primaries = graph.written(rows.filter("is_primary"))
    return settle(primaries, merge_links(primaries))


def members(areas: DataFrame, profiles: DataFrame) -> DataFrame:
    """canonical_area_id, area_id, member_role, quality, distance_meters and source of every served area."""
    rows = graph.written(candidates(areas, profiles))
    merged = graph.written(merged_primaries(rows))
    on = lambda x: F.col(x) == 1
    urban = on("has_subway") | on("has_tram")
    first_role = F.when(on("has_rail_service") | urban, "PRIMARY_RAIL").when(on("bus_only"), "PRIMARY_BUS").otherwise("PRIMARY_STOP")
    second_role = F.when(on("has_train") | on("has_rail_service"), "RAIL_PLATFORM").when(urban, "NEARBY_URBAN").when(on("bus_only"), "BUS_FEEDER").otherwise("ALIAS_ONLY")
    own = merged.join(rows.select("area_id", *FLAGS), "area_id")
    head = F.col("head") == F.col("area_id")
    primaries = own.select("head", "area_id", F.when(head, first_role).otherwise(second_role).alias("member_role"), F.when(head, "GOOD").otherwise(c.family_quality(F.col("distance_meters"))).alias("quality"), F.coalesce("distance_meters", F.lit(0)).alias("distance_meters"), F.when(head, "PRIMARY_PROFILE").otherwise("PRIMARY_FAMILY_MERGE").alias("source"))
    # feeders: near an anchor of the family, within reach of its head; the first family counts
    anchors = merged.select("head", F.col("area_id").alias("anchor"))
    sides = graph.written(_side(rows, "x").withColumnRenamed("x_area_id", "id"))
    points = merged.select("area_id").join(rows.select("area_id", "area_lat", "area_lon"), "area_id")
    close = derive.nearby_pairs(points, "area_id", "area_lat", "area_lon", CELL, 1, 2000, rows.filter("NOT is_primary")).select(F.col("from_id").alias("anchor"), F.col("to_id").alias("area_id"))
    met = close.join(anchors, "anchor").join(rows.filter("NOT is_primary").select("area_id", "bus_only", "has_subway", "has_tram", F.col("signal").alias("own_signal"), F.col("words").alias("o_words"), F.col("main_station_signal").alias("o_main_station_signal"), F.col("area_lat").alias("o_lat"), F.col("area_lon").alias("o_lon")), "area_id")
    tagged = lambda tag, key: sides.select(F.col("id").alias(key), F.col("x_words").alias(f"{tag}_words"), F.col("x_main_station_signal").alias(f"{tag}_main_station_signal"), F.col("x_area_lat").alias(f"{tag}_lat"), F.col("x_area_lon").alias(f"{tag}_lon"))
    met = met.join(tagged("h", "head"), "head").join(tagged("a", "anchor"), "anchor")
    metres = c.metres(F.col("h_lat"), F.col("h_lon"), F.col("o_lat"), F.col("o_lon"))
    role = F.when(on("bus_only"), "BUS_FEEDER").when(urban, "NEARBY_URBAN")
    met = met.withColumns({"d": metres, "role": role}).filter((F.col("d") <= FEEDER_METRES) & (same_place("h", "o") | same_place("a", "o")) & F.col("role").isNotNull() & ((F.col("role") != "BUS_FEEDER") | F.col("own_signal")))
    ranks = rows.select(F.col("area_id").alias("head"), "rank")
    fed = met.select("head", "area_id", "d", "role").distinct().join(ranks, "head").groupBy("area_id").agg(F.min_by(F.struct("head", "d", "role"), "rank").alias("x"))
    feeders = fed.select(F.col("x.head").alias("head"), "area_id", F.col("x.role").alias("member_role"), F.when(F.col("x.d") <= 150, "GOOD").when(F.col("x.d") <= 250, "OK").otherwise("LONG").alias("quality"), F.col("x.d").alias("distance_meters"), F.lit("NEARBY_PROFILE_DISTANCE").alias("source"))
    taken = graph.written(primaries.union(feeders))
    rest = rows.filter("route_count > 0").join(taken.select("area_id"), "area_id", "left_anti")
    alone = rest.select(F.col("area_id").alias("head"), "area_id", first_role.alias("member_role"), F.lit("GOOD").alias("quality"), F.lit(0).cast("long").alias("distance_meters"), F.lit("STANDALONE_ACTIVE_AREA").alias("source"))
    return taken.union(alone).select(F.concat(F.lit("CAN_"), "head").alias("canonical_area_id"), F.col("head").alias("primary_area_id"), "area_id", "member_role", "quality", "distance_meters", "source")


def with_access(family: DataFrame, profiles: DataFrame) -> DataFrame:
    """Members with what they are for, how they are shown, and the minutes to their primary."""
    role, on = F.col("member_role"), (lambda x: F.col(x) == 1)
    first = role.startswith("PRIMARY_")
    shown = (
        F.when(first & on("has_train"), "Fernbahn / Regionalbahn").when(first & on("has_subway"), "U-Bahn").when(first & on("has_tram"), "Tram / Stadtbahn").when(first & on("bus_only"), "Bus").when(first, "Primaerer Routinganker")
        .when(role == "BUS_FEEDER", "Bus / ZOB / Vorplatz").when((role == "RAIL_PLATFORM") & on("has_train"), "Weitere Fernbahn / Regionalbahn").when(role == "RAIL_PLATFORM", "Weiterer Rail-Anker")
        .when(role == "NEARBY_URBAN", "S-/U-/Tram-Umstieg").otherwise("Technisches Mitglied")
    )
    rows = family.join(profiles.select("area_id", "has_train", "has_subway", "has_tram", "bus_only"), "area_id")
    minutes = F.when(first, 0).otherwise(c.access_minutes(F.col("distance_meters")))
    return rows.select(*family.columns, shown.alias("display_role"), first.cast("int").alias("is_primary_for_search"), (first | role.isin("RAIL_PLATFORM", "NEARBY_URBAN")).cast("int").alias("is_primary_for_routing"), first.cast("int").alias("is_visible_suggestion"), minutes.alias("access_cost_minutes"))


def family_edges(access: DataFrame) -> DataFrame:
    """Ways within families: a primary to itself at no cost, and both ways between a member and its primary."""
    own = access.filter("area_id = primary_area_id")
    zero = F.lit(0).cast("long")
    same = own.select("canonical_area_id", F.col("area_id").alias("from_area_id"), F.col("area_id").alias("to_area_id"), zero.alias("distance_meters"), F.lit(0).alias("access_minutes"), F.lit("GOOD").alias("quality"), F.lit("SAME_CANONICAL_PRIMARY").alias("source"))
    rest = access.filter("area_id <> primary_area_id").withColumn("q", c.family_quality(F.col("distance_meters")))
    way = lambda a, b: rest.select("canonical_area_id", F.col(a), F.col(b), "distance_meters", "access_cost_minutes", "q", F.lit("CANONICAL_FAMILY_DISTANCE"))
    return same.union(way("area_id", "primary_area_id")).union(way("primary_area_id", "area_id"))


LEVELS = ("oben", "tief", "upper", "lower")


def alias_scores(alias: DataFrame) -> DataFrame:
    """Aliases with display texts and scores as a family's name, as its city's plain station, and as a special place of its city; null where one doesn't count.

    ``alias`` has alias, alias_normalized, alias_type, source, priority and city (the primary's).
    """
    n, kind, source, city = F.col("alias_normalized"), F.col("alias_type"), F.col("source"), F.coalesce("city", F.lit(""))
    rows = alias.withColumns({"shown": names.clean_display(F.col("alias")), "place": c.plain(city)})
    shown = F.col("shown")
    main = c.contains_token(n, "hbf") | n.contains("hauptbahnhof")
    usable = (shown != "") & ~n.contains("central station") & ~n.contains("flixtrain") & ~names.any_of([c.contains_token(n, w) for w in LEVELS]) & (names.city_name(shown) != "") & names.station_words(n)
    score = F.col("priority") + F.when(kind == "CANONICAL", 60).when(kind == "STATION_SYNONYM", 45).when(kind == "RAIL_STATION_INTENT", 35).otherwise(0) + F.when(source == "STOP_NAME", 30).otherwise(0) + F.when(main, 25).otherwise(0)
    rows = rows.withColumns({"_city": names.city_name(shown)}).withColumn("_station", names.station_name(shown, F.col("_city")))
    text = F.when((F.col("_city") != "") & c.plain(F.col("_station")).contains("hauptbahnhof"), F.concat("_city", F.lit(" Hbf"))).otherwise(shown)
    p = F.col("place")
    either = lambda w: (n == F.concat(p, F.lit(f" {w}"))) | (n == F.concat(F.lit(f"{w} "), p))
    of_main, of_station = either("hbf") | either("hauptbahnhof"), either("bahnhof") | either("bf")
    plain_score = F.col("priority") + F.when(of_main, 100).otherwise(50) + F.when(kind == "CANONICAL", 30).otherwise(0) + F.when(source == "STOP_NAME", 20).otherwise(0)
    s = c.plain(shown)
    bare = s.isin("hbf", "hauptbahnhof", "bahnhof", "bf")
    platform = names.any_of([c.contains_token(s, w) for w in ("gleis", "platform", "steig", "bahnsteig")])
    special = (p != "") & kind.isin("CANONICAL", "CITY_QUALIFIED", "STATION_SYNONYM", "RAIL_STATION_INTENT") & (s != "") & (s != p) & ~bare & ~names.technical(s) & ~platform
    own = F.when(s.startswith(F.concat(p, F.lit(" "))), shown).otherwise(names.clean_display(F.concat(city, F.lit(" "), shown)))
    special_score = F.col("priority") + F.when(kind == "CANONICAL", 60).when(kind == "STATION_SYNONYM", 40).otherwise(0) + F.when(source == "STOP_NAME", 35).when(source == "AREA_NAME", 20).otherwise(0) + F.when(names.station_words(s), 20).otherwise(0)
    return rows.select(
        "canonical_area_id", F.when(usable, F.struct(score.alias("s"), text.alias("t"))).alias("best"),
        F.when((p != "") & (of_main | of_station), F.struct(plain_score.alias("s"), F.concat(city, F.when(of_main, " Hbf").otherwise(" Bahnhof")).alias("t"))).alias("plain_station"),
        F.when(special, F.struct(special_score.alias("s"), (-F.length(own)).alias("l"), own.alias("t"))).alias("special"),
    )


def family_names(family: DataFrame, areas: DataFrame, profiles: DataFrame, alias: DataFrame, cities: DataFrame) -> DataFrame:
    """canonical_area_id, display_name, original_name, city_name, station_name, name_order, display_quality, primary_area_id and member_count of families.

    A member's name that says the station best is taken; where it says no more than the
    city, or too little, the best alias of the members takes its place.
    """
    blank = F.lit("")
    facts = areas.select("area_id", "area_name").join(profiles.select("area_id", *FLAGS), "area_id")
    city = cities.select("area_id", F.coalesce("city_name", blank).alias("city"))
    heads = family.select("canonical_area_id", "primary_area_id").distinct().join(facts.withColumnRenamed("area_id", "primary_area_id"), "primary_area_id").join(city.withColumnRenamed("area_id", "primary_area_id"), "primary_area_id", "left").withColumn("city", F.coalesce("city", blank))
    heads = heads.withColumn("p_city", c.plain(names.city_name(F.col("area_name"))))
    head = heads.select("canonical_area_id", F.col("area_name").alias("original_name"), "primary_area_id", "city", "p_city", F.col("has_train").alias("p_train"), F.col("has_rail_service").alias("p_rail"), F.col("main_station_signal").alias("p_main"), F.col("station_name_signal").alias("p_station"))
    rows = graph.spread(family.select("canonical_area_id", "area_id").join(facts, "area_id").join(head, "canonical_area_id")).withColumn("shown", names.clean_display(F.col("area_name"))).withColumn("n", c.plain(F.col("shown")))
    on, n = (lambda x: F.col(x) == 1), F.col("n")
    plain = names.any_of([n == F.concat("p_city", F.lit(w)) for w in (" bahnhof", " hbf", " hauptbahnhof")])
    # fixed values of the scores
    score = (
        F.when(on("station_name_signal"), 120).otherwise(0) + F.when(on("main_station_signal"), 80).otherwise(0) + F.when(~names.technical(n), 70).otherwise(0) + F.when((F.col("p_city") != "") & plain, 160).otherwise(0)
        - F.when(names.any_of([n.contains(x) for x in ("bahnhofstr", "kaiserstr", "kirchenallee", "steintordamm")]), 140).otherwise(0) - F.when(n.contains("zob") | n.contains("bus"), 120).otherwise(0) - F.when(on("bus_only"), 20).otherwise(0)
    )
    order = F.struct((-F.col("station_name_signal")).alias("a"), (-score).alias("b"), F.length("shown").alias("d"), "area_id")
    best = rows.groupBy("canonical_area_id").agg(F.min_by(F.struct("area_name", "shown"), order).alias("m"), F.count("*").alias("member_count"))
    scored = alias_scores(graph.spread(family.select("canonical_area_id", "area_id").join(alias, "area_id").join(head.select("canonical_area_id", "city"), "canonical_area_id")))
    told = scored.groupBy("canonical_area_id").agg(F.max("best").alias("best"), F.max("plain_station").alias("plain_station"), F.max("special").alias("special"))
    out = graph.spread(head.join(best, "canonical_area_id").join(told, "canonical_area_id", "left"))
    text = lambda x: F.coalesce(F.col(x)["t"], blank)
    only_city = on("p_rail") & (F.col("city") != "") & (c.plain(F.col("m.shown")) == c.plain(F.col("city")))
    out = out.withColumns({"only_city": only_city, "by_alias": F.when(only_city & on("p_train"), text("plain_station")).otherwise(text("best"))})
    out = out.withColumn("by_alias", F.when((F.col("by_alias") == "") & F.col("only_city"), text("special")).otherwise(F.col("by_alias")))
    bare = lambda x: c.plain(x).isin("hbf", "hauptbahnhof", "bahnhof", "bf")
    level = lambda x: names.station_words(c.plain(x)) & names.any_of([c.contains_token(c.plain(x), w) for w in LEVELS])
    short = lambda x: names.city_name(x) == ""
    given, m = F.col("by_alias") != "", F.col("m.area_name")
    out = out.withColumn("pick", F.when(given & (bare(F.col("m.shown")) | level(m) | short(F.col("m.shown")) | F.col("only_city")), F.col("by_alias")).otherwise(F.col("m.shown")))
    out = out.withColumn("pick", F.when(names.technical(c.plain(F.col("pick"))) & (F.col("original_name") != m), names.clean_display(F.col("original_name"))).otherwise(F.col("pick")))
    out = out.withColumn("pick", F.when(given & (bare(F.col("pick")) | level(F.col("original_name")) | short(F.col("pick"))), F.col("by_alias")).otherwise(F.col("pick")))
    town = names.city_name(F.col("original_name"))
    out = out.withColumn("pick", F.when(names.technical(c.plain(F.col("pick"))) & (town != "") & (on("p_main") | on("p_rail")), F.concat(town, F.lit(" Bahnhof"))).otherwise(F.col("pick")))
    out = out.withColumn("is_station", on("p_main") | on("p_station") | on("p_rail")).withColumnRenamed("city", "official_city")
    named = names.harmonised(out, "original_name", "is_station", "pick", "official_city")
    return named.select("canonical_area_id", "display_name", "original_name", "city_name", "station_name", "name_order", "display_quality", "primary_area_id", "member_count")


def family_aliases(family: DataFrame, alias: DataFrame) -> DataFrame:
    """Aliases of primary areas from their family's name, in its forms, that the area doesn't have yet."""
    shown, blank = F.col("display_name"), F.array().cast("array<struct<alias:string,priority:int>>")
    n = c.normalised(shown)
    entry = lambda test, text, p: F.when(test, F.array(F.struct(text.alias("alias"), F.lit(p).alias("priority")))).otherwise(blank)
    forms = F.concat(
        entry(F.lit(True), shown, 115), entry(n.contains("hauptbahnhof"), F.regexp_replace(shown, "(?i)hauptbahnhof", "Hbf"), 108), entry(c.contains_token(n, "hbf"), F.regexp_replace(shown, r"(?i)\bhbf\b", "Hauptbahnhof"), 108),
        entry(n.contains("bahnhof"), F.regexp_replace(shown, "(?i)bahnhof", "Bf"), 104), entry(c.contains_token(n, "bf"), F.regexp_replace(shown, r"(?i)\bbf\b", "Bahnhof"), 104),
    )
    rows = family.select(F.col("primary_area_id").alias("area_id"), F.inline(forms)).withColumn("alias_normalized", c.plain(F.col("alias"))).filter("alias_normalized <> ''")
    kinds = {"alias_type": F.lit("CANONICAL_FAMILY"), "source": F.lit("CANONICAL_STOP_AREA")}
    own = rows.groupBy("area_id", "alias_normalized").agg(F.min_by(F.struct("alias", "priority"), F.struct((-F.col("priority")).alias("p"), "alias")).alias("x")).select("area_id", F.col("x.alias").alias("alias"), "alias_normalized", F.col("x.priority").alias("priority")).withColumns(kinds)
    key = ["area_id", "alias_normalized", "alias_type", "source"]
    return alias.unionByName(own.join(alias.select(*key), key, "left_anti").select(*alias.columns))
