"""Links between complaints, incidents, meters and readings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridvoice.functions import columns as C
from gridvoice.functions.skew import broadcast_if_few, left_join_heavy, nearest_point
from gridvoice.sources.scratch import materialise

LOOK_BACK_DAYS = 180


def link_nearest_incident(
    complaints: DataFrame, incidents: DataFrame, days: int = 3, cell: float = 0.25
) -> DataFrame:
    """Closest incident of the region active at the complaint's creation, with its distance in km.

    An incident counts from its day (midnight) to midnight ``days`` days later. The
    range becomes an equality on (region, day, exactly midnight) by listing the days
    an incident is active. The search runs once per distinct place of a region-day,
    so copies and busy places cost nothing, and compares a place only with the
    incidents that can be nearest to its cell (``nearest_point``). Without a place, or without a placed incident, the smallest
    incident id of the region-day is taken and the distance is null.
    """
    keys = ["region", "_jour", "_minuit"]
    jour = F.to_date("date_creation")
    placed = complaints.withColumns({"_jour": jour, "_minuit": F.col("date_creation") == jour.cast("timestamp")})
    slots = F.array(
        *[F.struct(F.lit(d).alias("d"), F.lit(m).alias("m")) for d in range(days) for m in (False, True)],
        F.struct(F.lit(days).alias("d"), F.lit(True).alias("m")),
    )
    active = incidents.select("id_incident", "region", "date_incident", "latitude", "longitude", F.explode(slots).alias("_s"))
    active = active.select(
        "id_incident",
        "region",
        F.expr("date_add(date_incident, _s.d)").alias("_jour"),
        F.col("_s.m").alias("_minuit"),
        "latitude",
        "longitude",
    )
    known = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    sites = placed.filter(known).select(*keys, "latitude", "longitude").distinct()
    points = active.filter(known).groupBy(*keys, "latitude", "longitude").agg(F.min("id_incident").alias("id_incident"))
    nearest = nearest_point(sites, points, keys, "id_incident", cell, C.KM_PER_DEGREE)
    anyone = materialise(active.groupBy(*keys).agg(F.min("id_incident").alias("_any")), "anyone")
    return (
        placed.join(nearest.hint("merge"), [*keys, "latitude", "longitude"], "left")
        .join(broadcast_if_few(anyone, anyone.count()), keys, "left")
        .select(
            *complaints.columns,
            F.coalesce("id_incident", "_any").alias("incident_lie"),
            F.col("distance").alias("distance_incident_km"),
        )
    )


def enrich_with_meters(complaints: DataFrame, meters: DataFrame) -> DataFrame:
    """Meter attributes and age at the complaint; complaints without a known meter keep nulls.

    Cleaning turns every invalid reference into a null. Those rows take no part in the join, so they are not one hot key, and
    neither is a meter with very many complaints.
    """
    attributes = meters.select(
        "reference_linky",
        "type_compteur",
        "puissance_souscrite_kva",
        "date_installation",
        "est_defectueux",
        "nombre_incidents",
    )
    joined = left_join_heavy(complaints, attributes, "reference_linky")
    return joined.withColumn("anciennete_compteur_jours", F.datediff("date_creation", "date_installation"))


def abnormal_readings_before(complaints: DataFrame, readings: DataFrame, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Number and mean consumption of abnormal readings in the ``days`` days before each complaint.

    Readings are summed per meter and day and the wanted (meter, day) points are
    added as empty rows; a range window over days then gives every sum. No
    complaint × reading pair is built, and a meter's group is bounded by the number
    of days, however many readings or complaints it has.
    """
    meter, jour = "reference_linky", F.to_date("date_creation")
    daily = (
        readings.filter("anomalie_detectee")
        .groupBy(meter, F.col("date_releve").alias("_jour"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("consommation_kwh").alias("_kwh"),
            F.count("consommation_kwh").alias("_nk"),
        )
    )
    asked = (
        complaints.filter(F.col(meter).isNotNull())
        .select(meter, jour.alias("_jour"))
        .distinct()
        .withColumns({"_n": F.lit(0).cast("long"), "_kwh": F.lit(None).cast("double"), "_nk": F.lit(0).cast("long")})
    )
    points = (
        daily.withColumn("_asked", F.lit(False))
        .unionByName(asked.withColumn("_asked", F.lit(True)))
        .groupBy(meter, "_jour")
        .agg(F.sum("_n").alias("_n"), F.sum("_kwh").alias("_kwh"), F.sum("_nk").alias("_nk"), F.max("_asked").alias("_asked"))
    )
    number = F.datediff("_jour", F.lit("1970-01-01").cast("date"))
    window = W.partitionBy(meter).orderBy(number).rangeBetween(-days, 0)
    history = (
        points.select(
            F.col(meter).alias("_meter"),
            F.col("_jour").alias("_day"),
            "_asked",
            F.sum("_n").over(window).alias("nb_anomalies_releves_6mois"),
            F.try_divide(F.sum("_kwh").over(window), F.sum("_nk").over(window)).alias("conso_moyenne_6mois"),
        )
        .filter("_asked")
        .drop("_asked")
    )
    joined = complaints.join(history, (F.col(meter) == F.col("_meter")) & (jour == F.col("_day")), "left")
    return joined.drop("_meter", "_day").fillna(0, ["nb_anomalies_releves_6mois"])


def linky_kpis(df: DataFrame) -> DataFrame:
    """Meter-complaint figures per region; figures of absent enrichment columns are left out."""
    total = F.count(F.lit(1))
    figures = [
        total.alias("nb_reclamations_linky"),
        F.count_if(~F.col("reference_valide")).alias("nb_references_invalides"),
    ]
    if "est_defectueux" in df.columns:
        defective = F.count_if("est_defectueux")
        figures += [
            defective.alias("nb_compteurs_defectueux"),
            C.rate(defective, total).alias("taux_compteurs_defectueux"),
        ]
    if "nb_anomalies_releves_6mois" in df.columns:
        figures.append(F.avg("nb_anomalies_releves_6mois").alias("moyenne_anomalies_par_compteur"))
    return df.groupBy("region").agg(*figures)


#: Levels of the index of days: an interval of level k is 2 ** k days. The highest is 45 years, longer lives take more of it.
LEVELS = range(0, 16, 2)
#: Side of a cell in half sides of a box: a box touches one or two cells a side.
CELL = 4
#: A hot node is cut into so many parts a side.
CUTS = 8


def _nodes(first: Column, last: Column, level: Column) -> Column:
    """The intervals of a level that the days ``first`` to ``last`` hold whole, less those that lie in a whole interval of the next level."""
    scale = F.call_function("shiftleft", F.lit(1), level)
    low, high = F.call_function("shiftright", first + scale - 1, level), F.call_function("shiftright", last + 1, level) - 1
    top = level == max(LEVELS)
    above, upto = F.shiftright(low + 3, 2), F.shiftright(high + 1, 2) - 1  # whole intervals of the next level
    single = top | (above > upto)
    nothing = F.array().cast("array<int>")

    def between(a: Column, b: Column) -> Column:
        return F.when(a <= b, F.sequence(a, b)).otherwise(nothing)

    return F.when(single, between(low, high)).otherwise(F.concat(between(low, above * 4 - 1), between((upto + 1) * 4, high)))


def incident_nodes(incidents: DataFrame, as_of: str, half_side: float = 0.1) -> DataFrame:
    """One row per cell that an incident's box touches and per interval of the days of its life.

    Intervals are those of a tree of days, four of a level in one of the next, so the rows of an incident grow with the logarithm of
    its age. ``_within`` says that it lasts from before the interval to after it; on its first and last day hours decide.
    """
    side, margin = CELL * half_side, half_side + 1e-9
    epoch = F.lit("1970-01-01").cast("date")

    def cells(c: str) -> Column:
        return F.sequence(F.floor((F.col(c) - margin) / side), F.floor((F.col(c) + margin) / side))

    lives = incidents.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.col("latitude").alias("_ilat"),
        F.col("longitude").alias("_ilon"),
        F.col("date_incident").cast("timestamp").alias("_start"),
        F.coalesce(F.col("date_fin").cast("timestamp"), C.moment(as_of)).alias("_end"),
    )
    lives = materialise(lives.filter(F.col("_end") >= F.col("_start")).distinct(), "lives")
    lives = lives.withColumns({"_first": F.datediff("_start", epoch), "_last": F.datediff("_end", epoch)})
    levels = F.explode(F.array(*[F.lit(k) for k in LEVELS]))
    nodes = lives.withColumn("_level", levels).withColumn("_node", F.explode(_nodes(F.col("_first"), F.col("_last"), F.col("_level"))))
    scale = F.call_function("shiftleft", F.lit(1), F.col("_level"))
    within = (F.col("_node") * scale > F.col("_first")) & ((F.col("_node") + 1) * scale <= F.col("_last"))
    return (
        nodes.withColumn("_within", within)
        .withColumn("_cx", F.explode(cells("_ilat")))
        .withColumn("_cy", F.explode(cells("_ilon")))
        .select("_cx", "_cy", "_level", "_node", "_within", "_ilat", "_ilon", "_start", "_end")
    )


def in_incident_zone(
    complaints: DataFrame, incidents: DataFrame, as_of: str, half_side: float = 0.1, hot: int = 500
) -> DataFrame:
    """Whether a complaint lies in an incident's box (± ``half_side`` degrees) during its life.

    Incidents lie in an index of grid cells and intervals of days (``incident_nodes``); a complaint looks up its cell and the
    intervals that hold its day, so the match is an equality with a residual check. A node with more than ``hot`` incidents is cut into
    eight by eight parts: an incident whose box holds a whole part answers for all places in it without a comparison, and only
    those at the rim of a part are compared. The search runs on distinct places and times with semi joins: matching pairs are never produced.
    Rows of nodes and parts are counted, and broadcast only if they are few.
    """
    side = CELL * half_side
    epoch = F.lit("1970-01-01").cast("date")
    nodes = incident_nodes(incidents, as_of, half_side)
    place, key = ["_lat", "_lon", "_at"], ["_cx", "_cy", "_level", "_node"]
    sites = complaints.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"), F.col("date_creation").alias("_at")
    )
    day = F.datediff("_at", epoch)
    per_node = nodes.groupBy(*key).agg(F.count(F.lit(1)).alias("_i"))
    full = F.col("_i") > hot
    found = per_node.agg(
        F.sort_array(F.collect_set("_level")).alias("levels"),
        F.count_if(full).alias("crowded"),
        F.coalesce(F.sum(F.when(full, F.col("_i"))), F.lit(0)).alias("in_crowded"),
        F.coalesce(F.sum(F.when(~full, F.col("_i"))), F.lit(0)).alias("in_others"),
    ).first()
    some = found["crowded"] > 0
    asked = [F.struct(F.lit(k).alias("level"), F.shiftright(day, k).alias("node")) for k in found["levels"] or [0]]
    looked = (
        sites.distinct()
        .withColumn("_n", F.explode(F.array(*asked)))
        .select(
            *place,
            F.floor(F.col("_lat") / side).alias("_cx"),
            F.floor(F.col("_lon") / side).alias("_cy"),
            F.col("_n.level").alias("_level"),
            F.col("_n.node").alias("_node"),
        )
    )
    crowded = broadcast_if_few(materialise(per_node.filter(full).select(*key), "crowded"), found["crowded"]) if some else None

    def kind(df: DataFrame, how: str) -> DataFrame:
        return df.join(crowded, key, how) if some else df

    def inside(a: DataFrame, b: DataFrame, on: list[str]) -> Column:
        return (
            reduce(lambda x, y: x & y, [a[c] == b[c] for c in on])
            & a["_lat"].between(b["_ilat"] - half_side, b["_ilat"] + half_side)
            & a["_lon"].between(b["_ilon"] - half_side, b["_ilon"] + half_side)
            & a["_at"].between(b["_start"], b["_end"])
        )

    plain, known = kind(looked, "left_anti"), broadcast_if_few(kind(nodes, "left_anti"), found["in_others"])
    hits = plain.join(known, inside(plain, known, key), "left_semi").select(*place)
    if some:
        part = side / CUTS
        cut = kind(looked, "left_semi").withColumns({"_px": F.floor(F.col("_lat") / part), "_py": F.floor(F.col("_lon") / part)})

        def parts(c: str, cell: str) -> Column:
            low, high = F.floor((F.col(c) - half_side - 1e-9) / part), F.floor((F.col(c) + half_side + 1e-9) / part)
            first, last = F.col(cell) * CUTS, F.col(cell) * CUTS + CUTS - 1
            # a place on the rim of a cell may be rounded into the next part
            return F.sequence(F.greatest(low, first - 1), F.least(high, last + 1))

        def holds(c: str, p: str) -> Column:
            return (F.col(p) * part - 1e-9 >= F.col(c) - half_side) & ((F.col(p) + 1) * part + 1e-9 <= F.col(c) + half_side)

        spread = (
            kind(nodes, "left_semi").withColumn("_px", F.explode(parts("_ilat", "_cx"))).withColumn("_py", F.explode(parts("_ilon", "_cy")))
        )
        spread = spread.withColumn("_whole", F.col("_within") & holds("_ilat", "_px") & holds("_ilon", "_py"))
        cut_key = [*key, "_px", "_py"]
        at_most = found["in_crowded"] * (CUTS + 2) ** 2
        whole = broadcast_if_few(spread.filter("_whole").select(*cut_key).distinct(), at_most)
        hits = hits.unionByName(cut.join(whole, cut_key, "left_semi").select(*place))
        open_, rim = cut.join(whole, cut_key, "left_anti"), broadcast_if_few(spread.filter("NOT _whole"), at_most)
        hits = hits.unionByName(open_.join(rim, inside(open_, rim, cut_key), "left_semi").select(*place))
    hits = hits.distinct().withColumn("_hit", F.lit(True))
    same = (
        (F.col("latitude") == F.col("_lat"))
        & (F.col("longitude") == F.col("_lon"))
        & (F.col("date_creation") == F.col("_at"))
    )
    marked = complaints.join(hits, same, "left").withColumn("est_lie_incident", F.coalesce("_hit", F.lit(False)))
    return marked.drop("_lat", "_lon", "_at", "_hit")


def with_client_history(complaints: DataFrame, clients: DataFrame) -> DataFrame:
    """Left join of client attributes, one row per complaint; a client with very many complaints is not one task."""
    return left_join_heavy(complaints, clients, "client_id")
