"""Registered queries of the hierarchy engine and their oracles in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..functions import names
from ..operators import diff, hierarchy, normalize, partition, reconcile, semgraph, separators
from ..sources import catalog, readers
from .views import SY, TX, TX2, region_roots, sy, table, tx, tx2

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CL = "cl AS (SELECT uid AS des, uid AS anc, 0 AS dist FROM tx UNION ALL SELECT cl.des, t.par_id, cl.dist + 1 FROM cl JOIN tx t ON cl.anc = t.uid WHERE t.par_id IS NOT NULL)"
TIPS = "tips AS (SELECT uid FROM tx WHERE uid NOT IN (SELECT par_id FROM tx WHERE par_id IS NOT NULL))"
ROOTS = "rt AS (SELECT uid, CASE WHEN rank = 'kingdom' THEN name ELSE concat('AFRICA/', name) END AS fragment FROM tx WHERE rank = 'kingdom' OR (rank = 'phylum' AND par_id = 'r0'))"
PART = f"{ROOTS}, pt AS (SELECT t.uid, t.par_id, t.name, coalesce((SELECT arg_min(rt.fragment, cl.dist) FROM cl JOIN rt ON rt.uid = cl.anc WHERE cl.des = t.uid), '__misc__') AS fragment FROM tx t)"
HEAD = f"WITH RECURSIVE {TX}, {CL}, {TIPS}"
DIFF = f"""WITH {TX}, {TX2},
k1 AS (SELECT DISTINCT par_id FROM tx WHERE par_id IS NOT NULL), k2 AS (SELECT DISTINCT par_id FROM tx2 WHERE par_id IS NOT NULL),
both_ AS (SELECT coalesce(a.uid, b.uid) AS uid, a.uid AS ou, b.uid AS nu, a.par_id AS op, b.par_id AS np, a.name AS onm, b.name AS nnm, a.rank AS ork, b.rank AS nrk
  FROM tx a FULL JOIN tx2 b ON a.uid = b.uid)"""


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def listed(c: str):
    return F.array_join(F.array_sort(F.col(c)), ",")


# --- hierarchy

@query(f"{HEAD} SELECT uid FROM tx WHERE par_id IS NULL")
def tx_roots(spark, d):
    return hierarchy.roots(tx(spark, d))


@query(f"{HEAD} SELECT uid FROM tips")
def tx_leaves(spark, d):
    return hierarchy.leaves(tx(spark, d))


@query(f"{HEAD} SELECT des AS uid, CAST(max(dist) AS BIGINT) AS depth FROM cl GROUP BY des")
def tx_depths(spark, d):
    return hierarchy.depths(tx(spark, d)).select("uid", "depth")


@query(f"{HEAD} SELECT anc, CAST(dist AS BIGINT) AS dist, count(*) AS n FROM cl GROUP BY anc, dist")
def tx_closure_counts(spark, d):
    return hierarchy.closure(tx(spark, d)).groupBy("anc", F.col("dist").cast("long").alias("dist")).agg(F.count("des").alias("n"))


@query(f"{HEAD} SELECT t.uid, t.name FROM tx t JOIN cl ON cl.des = t.uid WHERE cl.anc = 'n3'")
def tx_subtree(spark, d):
    t = tx(spark, d)
    return hierarchy.subtree(t, t.filter("uid = 'n3'")).select("uid", "name")


@query(f"{HEAD}, {SY} SELECT s.uid, s.name, s.syn_type FROM sy s JOIN cl ON cl.des = s.uid WHERE cl.anc = 'n3'")
def tx_subtree_synonyms(spark, d):
    t = tx(spark, d)
    return hierarchy.subtree_with_synonyms(t, sy(spark, d), t.filter("uid = 'n3'"))[1].select("uid", "name", "syn_type")


@query(f"{HEAD} SELECT anc AS uid, CAST(dist AS BIGINT) AS dist FROM cl WHERE des = 'o7'")
def tx_path_to_root(spark, d):
    return hierarchy.path_to_root(tx(spark, d), "o7").select("uid", F.col("dist").cast("long").alias("dist"))


@query(f"{HEAD} SELECT anc AS uid, count(*) AS n_tips FROM cl JOIN tips ON tips.uid = cl.des GROUP BY anc")
def tx_tips_below(spark, d):
    return hierarchy.tips_below(tx(spark, d))


@query(f"{HEAD} SELECT par_id, count(*) AS n_children, string_agg(uid, ',' ORDER BY uid) AS children FROM tx WHERE par_id IS NOT NULL GROUP BY par_id")
def tx_children(spark, d):
    return hierarchy.children(tx(spark, d)).withColumn("children", listed("children"))


_WALK = "w AS (SELECT uid, [uid] AS path FROM tx WHERE par_id IS NULL UNION ALL SELECT t.uid, list_append(w.path, t.uid) FROM w JOIN tx t ON t.par_id = w.uid)"


@query(f"WITH RECURSIVE {TX}, {_WALK} SELECT uid, CAST(len(path) - 1 AS BIGINT) AS depth, row_number() OVER (ORDER BY path) AS preorder_idx FROM w")
def tx_preorder(spark, d):
    return hierarchy.preorder(tx(spark, d)).select("uid", F.col("depth").cast("long").alias("depth"), "preorder_idx")


@query(f"WITH RECURSIVE {TX}, {_WALK} SELECT uid, row_number() OVER (ORDER BY path DESC) AS postorder_idx FROM w")
def tx_postorder(spark, d):
    return hierarchy.postorder(tx(spark, d))


@query(f"{HEAD} SELECT t.uid, (SELECT min(cl.anc) FROM cl JOIN tx g ON g.uid = cl.anc WHERE g.rank = 'genus' AND cl.des = t.uid) AS genus_uid FROM tx t")
def tx_genus_of(spark, d):
    return hierarchy.genus_of(tx(spark, d))


_NUM = "CASE rank WHEN 'kingdom' THEN 270 WHEN 'genus' THEN 70 WHEN 'species' THEN 30 END"


@query(f"""WITH RECURSIVE {TX}, {CL}, num AS (SELECT uid, {_NUM} AS num FROM tx),
near AS (SELECT cl.des AS uid, min(cl.dist) AS up, arg_min(num.num, cl.dist) AS above FROM cl JOIN num ON num.uid = cl.anc WHERE cl.dist > 0 AND num.num IS NOT NULL GROUP BY cl.des),
below AS (SELECT cl.anc AS uid, max(num.num + cl.dist) AS below FROM cl JOIN num ON num.uid = cl.des LEFT JOIN near ON near.uid = cl.des
  WHERE cl.dist > 0 AND num.num IS NOT NULL AND (near.up IS NULL OR cl.dist < near.up) GROUP BY cl.anc),
b AS (SELECT num.uid, coalesce(num.num, coalesce(1 + below.below, 0)) AS low, coalesce(num.num, near.above - near.up) AS high FROM num LEFT JOIN near ON near.uid = num.uid LEFT JOIN below ON below.uid = num.uid)
SELECT b.uid, CAST(b.low AS BIGINT) AS low, CAST(b.high AS BIGINT) AS high, CAST((SELECT max(x.low + cl.dist) FROM cl JOIN b x ON x.uid = cl.des WHERE cl.anc = b.uid) AS BIGINT) AS best FROM b""")
def tx_best_rank(spark, d):
    t = tx(spark, d).withColumn("rank", F.when(F.col("rank") == "phylum", "no rank").otherwise(F.col("rank")))
    return hierarchy.rank_ranges(t).select("uid", *[F.col(c).cast("long").alias(c) for c in ("low", "high", "best")])


@query(f"{HEAD}, kids AS (SELECT cl.anc, string_agg(DISTINCT tx.rank, ',' ORDER BY tx.rank) AS found FROM cl JOIN tx ON tx.uid = cl.des GROUP BY cl.anc) SELECT anc AS uid, found FROM kids")
def tx_union_below(spark, d):
    t = tx(spark, d)
    return hierarchy.union_below(t, t.select("uid", F.col("rank").alias("value"))).withColumn("found", listed("found"))


@query(f"""{HEAD}, want AS (SELECT uid FROM tx WHERE par_id = 'n3' AND rank = 'genus')
SELECT anc AS uid, CAST((SELECT max(dist) FROM cl c2 WHERE c2.des = cl.anc) AS BIGINT) AS depth, count(*) AS n_found FROM cl JOIN want ON want.uid = cl.des
GROUP BY anc HAVING count(*) = (SELECT count(*) FROM want) ORDER BY depth DESC, uid LIMIT 1""")
def tx_mrca(spark, d):
    t = tx(spark, d)
    return hierarchy.mrca(t, t.filter("par_id = 'n3' and rank = 'genus'"))


@query(f"""{HEAD}, f AS (SELECT uid FROM tips WHERE right(uid, 1) IN ('1', '2', '3', '4', '5', '6') AND uid LIKE 'o%')
SELECT k.uid, CAST(n_found AS BIGINT) AS n_found, n_tips, CASE WHEN n_found = 0 THEN 'none' WHEN n_found = n_tips THEN 'only' WHEN 2 * n_found > n_tips THEN 'mainly' ELSE 'minor' END AS overlap
FROM (SELECT t.uid, (SELECT count(*) FROM cl JOIN f ON f.uid = cl.des WHERE cl.anc = t.uid) AS n_found, (SELECT count(*) FROM cl JOIN tips ON tips.uid = cl.des WHERE cl.anc = t.uid) AS n_tips FROM tx t WHERE t.par_id = 'r1') k""")
def tx_overlap(spark, d):
    t = tx(spark, d)
    wanted = hierarchy.leaves(t).filter("right(uid, 1) in ('1', '2', '3', '4', '5', '6') and uid like 'o%'")
    return hierarchy.overlap_children(t, "r1", wanted)


# --- partition

@query(f"{HEAD}, {PART} SELECT fragment, count(*) AS n_taxa, count(*) FILTER (WHERE uid IN (SELECT uid FROM tips)) AS n_tips FROM pt GROUP BY fragment")
def tx_partition(spark, d):
    t = tx(spark, d)
    tips = hierarchy.leaves(t).withColumn("tip", F.lit(1))
    assigned = partition.assign(t, region_roots(t)).join(tips, "uid", "left")
    return assigned.groupBy("fragment").agg(F.count("uid").alias("n_taxa"), F.count("tip").alias("n_tips"))


@query(f"{HEAD}, {PART} SELECT uid, fragment FROM pt")
def tx_assign(spark, d):
    t = tx(spark, d)
    return partition.assign(t, region_roots(t)).select("uid", "fragment")


# a partition with faults: species dropped, twice, in a fragment of nobody, in none; rows of taxa that do not exist; a root without a row
@query(f"""{HEAD}, {SY}, {PART}, x AS (SELECT uid, par_id, fragment, CASE WHEN uid LIKE 'o%' THEN CAST(substr(uid, 2) AS BIGINT) END AS k FROM pt),
y AS (SELECT uid, par_id, CASE WHEN k % 13 = 0 THEN 'Z' WHEN k % 23 = 0 THEN NULL ELSE fragment END AS fragment FROM x WHERE k IS NULL OR k % 19 <> 0),
p AS (SELECT * FROM y UNION ALL SELECT y.* FROM y WHERE uid LIKE 'o%' AND CAST(substr(uid, 2) AS BIGINT) % 17 = 0 UNION ALL SELECT 'ghost' || n_nationkey, 'absent', 'Z' FROM nation),
u AS (SELECT DISTINCT uid, fragment FROM p WHERE uid NOT LIKE 'o%')
SELECT 'duplicate_rows' AS check_name, count(*) AS n_violations FROM (SELECT uid FROM p GROUP BY uid HAVING count(*) > 1) z
UNION ALL SELECT 'root_without_row', count(*) FROM (SELECT uid FROM rt UNION ALL SELECT 'nowhere') z WHERE uid NOT IN (SELECT uid FROM p)
UNION ALL SELECT 'synonym_without_row', count(*) FROM sy WHERE uid NOT IN (SELECT uid FROM p)
UNION ALL SELECT 'unmarked_border', count(*) FROM p JOIN u ON u.uid = p.par_id WHERE p.fragment <> u.fragment AND p.uid NOT IN (SELECT uid FROM rt)
UNION ALL SELECT 'without_fragment', count(*) FROM p WHERE fragment IS NULL
UNION ALL SELECT 'missing', count(*) FROM tx WHERE uid NOT IN (SELECT uid FROM p)
UNION ALL SELECT 'extra', (SELECT count(*) FROM p) - (SELECT count(DISTINCT uid) FROM p WHERE uid NOT LIKE 'ghost%')""")
def tx_partition_check(spark, d):
    t = tx(spark, d)
    k = F.when(F.col("uid").startswith("o"), F.expr("try_cast(substr(uid, 2) AS BIGINT)"))
    parts = partition.staged_assignment(t, region_roots(t)).filter(k.isNull() | (k % 19 != 0))
    parts = parts.withColumn("fragment", F.when(k % 13 == 0, "Z").when(k % 23 == 0, None).otherwise(F.col("fragment"))).select("uid", "par_id", "fragment")
    ghosts = table(spark, d, "nation").select(F.concat(F.lit("ghost"), "n_nationkey"), F.lit("absent"), F.lit("Z")).toDF("uid", "par_id", "fragment")
    parts = parts.unionByName(parts.filter(k % 17 == 0)).unionByName(ghosts)
    roots = region_roots(t).select("uid", "fragment").unionByName(spark.createDataFrame([("nowhere", "N")], "uid string, fragment string"))
    return partition.validity(parts, sy(spark, d), roots).unionByName(partition.completeness(t, parts))


@query(f"{HEAD}, {PART}, {SY} SELECT fragment, count(*) AS n_synonyms FROM sy JOIN pt ON pt.uid = sy.uid GROUP BY fragment")
def tx_synonyms_move(spark, d):
    t = tx(spark, d)
    return partition.assign_synonyms(sy(spark, d), partition.assign(t, region_roots(t))).groupBy("fragment").agg(F.count("name").alias("n_synonyms"))


@query(f"{HEAD}, {PART} SELECT p.fragment AS parent_fragment, c.uid AS child_uid, c.fragment AS child_fragment FROM pt c JOIN pt p ON p.uid = c.par_id WHERE c.fragment <> p.fragment")
def tx_accum_des(spark, d):
    t = tx(spark, d)
    return partition.separated_children(partition.staged_assignment(t, region_roots(t)))


@query(f"{HEAD}, {PART} SELECT pt.uid, CASE WHEN cl.des IS NOT NULL THEN 'moved' ELSE pt.fragment END AS fragment FROM pt LEFT JOIN cl ON cl.des = pt.uid AND cl.anc = 'n4'")
def tx_move_subtree(spark, d):
    t = tx(spark, d)
    return partition.move_subtree(t, partition.assign(t, region_roots(t)), t.filter("uid = 'n4'"), "moved").select("uid", "fragment")


@query(f"{HEAD}, {PART} SELECT CASE WHEN fragment LIKE 'AFRICA/%' THEN 'AFRICA' ELSE fragment END AS fragment, count(*) AS n FROM pt GROUP BY 1")
def tx_deseparate(spark, d):
    t = tx(spark, d)
    up = region_roots(t).filter("fragment like 'AFRICA/%'").select("fragment", F.lit("AFRICA").alias("parent_fragment"))
    return partition.deseparate(partition.assign(t, region_roots(t)), up).groupBy("fragment").agg(F.count("uid").alias("n"))


@query(f"{HEAD}, {PART} SELECT fragment, count(*) AS n_taxa, count(DISTINCT name) AS n_names FROM pt GROUP BY fragment")
def tx_name_catalog(spark, d):
    t = tx(spark, d)
    return partition.catalog_of_names(partition.assign(t, region_roots(t)))


@query(f"{HEAD}, {PART} SELECT uid FROM pt WHERE fragment IN ('AFRICA/ALGERIA', '__misc__') OR fragment IN (SELECT 'AFRICA/' || name FROM tx WHERE uid = 'n0')")
def tx_slice_to_root(spark, d):
    t = tx(spark, d)
    first = t.filter("uid = 'n0'").first()["name"]
    return partition.slice_to_root(partition.assign(t, region_roots(t)), f"AFRICA/{first}", [""]).select("uid")


@query("SELECT src, fragment, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM (SELECT 'brand' AS src, p_type AS fragment, p_brand AS id FROM part UNION ALL SELECT 'size', p_type, CAST(p_size AS VARCHAR) FROM part) x GROUP BY src, fragment")
def src_partition_maps(spark, d):
    raw = F.concat(F.lit("brand:"), "p_brand", F.lit(",size:"), F.col("p_size").cast("string"))
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("uid"), F.col("p_type").alias("fragment"), model.parse_sources(raw).alias("src"))
    return partition.partition_maps(rows).withColumn("ids", listed("ids"))


# --- normalise

@query(f"{HEAD}, kept AS (SELECT * FROM tx WHERE NOT (rank = 'genus' AND right(uid, 1) = '7')) SELECT uid FROM kept WHERE par_id IS NOT NULL AND par_id NOT IN (SELECT uid FROM kept)")
def tx_orphans(spark, d):
    t = tx(spark, d)
    return normalize.orphans(normalize.delete(t, t.filter("rank = 'genus' and right(uid, 1) = '7'"))).select("uid")


@query(f"{HEAD} SELECT uid FROM tx WHERE uid NOT IN (SELECT des FROM cl WHERE anc IN ('n1', 'n2', 'c5'))")
def tx_prune(spark, d):
    t = tx(spark, d)
    return normalize.prune(t, t.filter("uid in ('n1', 'n2', 'c5')")).select("uid")


@query(f"{HEAD} SELECT uid FROM tx WHERE NOT (right(uid, 1) = '4' AND uid IN (SELECT uid FROM tips))")
def tx_remove_tips(spark, d):
    t = tx(spark, d)
    return normalize.remove_tips(t, t.filter("right(uid, 1) = '4'")).select("uid")


# containers within containers: some phyla, and every third genus, in these and elsewhere
@query(f"""{HEAD}, box AS (SELECT uid FROM tx WHERE uid IN ('n0', 'n5', 'n10', 'n15', 'n20') OR (rank = 'genus' AND CAST(substr(uid, 2) AS BIGINT) % 3 = 0)),
up AS (SELECT cl.des AS uid, arg_min(cl.anc, cl.dist) AS par_id FROM cl WHERE cl.dist > 0 AND cl.anc NOT IN (SELECT uid FROM box) GROUP BY cl.des)
SELECT t.uid, up.par_id, CASE WHEN t.par_id IN (SELECT uid FROM box) THEN 'incertae_sedis' ELSE '' END AS flags FROM tx t LEFT JOIN up ON up.uid = t.uid WHERE t.uid NOT IN (SELECT uid FROM box)""")
def tx_incertae(spark, d):
    t = tx(spark, d)
    boxes = F.col("uid").isin("n0", "n5", "n10", "n15", "n20") | ((F.col("rank") == "genus") & (F.expr("try_cast(substr(uid, 2) AS BIGINT)") % 3 == 0))
    out = normalize.collapse(t, t.filter(boxes))
    return out.select("uid", "par_id", model.format_flags(F.col("flags")).alias("flags"))


@query(f"{HEAD} SELECT DISTINCT anc AS uid FROM cl WHERE des IN (SELECT uid FROM tips WHERE right(uid, 2) = '42')")
def tx_keep_ancestors(spark, d):
    t = tx(spark, d)
    return normalize.keep_with_ancestors(t, hierarchy.leaves(t).filter("right(uid, 2) = '42'")).select("uid")


@query("SELECT DISTINCT 'auto:' || split_part(p_name, ' ', 1) AS uid, split_part(p_name, ' ', 1) AS name FROM part WHERE split_part(p_name, ' ', 1) NOT IN (SELECT p_name FROM part)")
def tx_autoparent(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("uid"), F.col("p_name").alias("name"))
    return normalize.auto_parents(rows).filter("rank = 'genus'").select("uid", "name")


@query("SELECT 's' || s_suppkey AS old_id, 's0' AS new_id FROM supplier WHERE s_suppkey > 0")
def syn_chain(spark, d):
    rows = table(spark, d, "supplier").filter("s_suppkey > 0")
    lowest = rows.agg(F.min("s_suppkey")).first()[0]
    up = F.when(F.col("s_suppkey") == lowest, F.lit(0)).otherwise(F.col("s_suppkey") - 1).cast("string")
    return normalize.resolve_chain(rows.select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("old_id"), F.concat(F.lit("s"), up).alias("new_id")))


@query("SELECT p_name AS name, count(*) AS n, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY CAST(p_partkey AS VARCHAR)) AS ids FROM part GROUP BY p_name HAVING count(*) > 1")
def names_repeated(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("uid"), F.col("p_name").alias("name"))
    return normalize.repeated_names(rows).withColumn("ids", listed("ids"))


@query("SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS uid, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def ids_repeated(spark, d):
    rows = table(spark, d, "lineitem").select(F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("uid"))
    return normalize.duplicate_ids(rows)


@query("SELECT p_type AS key, coalesce(arg_min(CAST(p_partkey AS VARCHAR), p_partkey) FILTER (WHERE p_size < 3), min(CAST(p_partkey AS VARCHAR))) AS id FROM part GROUP BY p_type")
def namepath_argmin(spark, d):
    rows = table(spark, d, "part").select(F.col("p_type").alias("key"), F.col("p_partkey").cast("string").alias("id"), F.col("p_partkey").alias("line"), (F.col("p_size") < 3).alias("preferred"))
    return normalize.preferred_id(rows)


@query("""SELECT CAST(p_partkey AS VARCHAR) AS acc, array_to_string(a[1:i], ';') AS prefix, a[i] AS element, CAST(i AS BIGINT) AS pos,
CASE WHEN i = len(a) THEN CAST(p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) || '/#' || i END AS id
FROM (SELECT p_partkey, string_split(p_type, ' ') AS a, unnest(generate_series(1, len(string_split(p_type, ' ')))) AS i FROM part) x""")
def path_explode(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("acc"), F.replace("p_type", F.lit(" "), F.lit(";")).alias("path"))
    return normalize.path_prefixes(rows).withColumn("pos", F.col("pos").cast("long"))


# --- scalar functions

@query("SELECT p_partkey AS uid, s.src AS src, s.id AS id FROM (SELECT p_partkey, unnest([{'src': 'brand', 'id': p_brand}, {'src': 'size', 'id': CAST(p_size AS VARCHAR)}]) AS s FROM part) x")
def src_parse(spark, d):
    raw = F.concat(F.lit("brand:"), "p_brand", F.lit(", size:"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("uid"), F.explode(model.parse_sources(raw)).alias("s")).select("uid", "s.src", "s.id")


@query("SELECT p_partkey AS uid, 'brand:' || p_brand || ',size:' || p_size AS src FROM part")
def src_format(spark, d):
    raw = F.concat(F.lit("size:"), F.col("p_size").cast("string"), F.lit(",brand:"), "p_brand", F.lit(",brand:"), "p_brand")
    return table(spark, d, "part").select(F.col("p_partkey").alias("uid"), model.format_sources(model.parse_sources(raw)).alias("src"))


@query("SELECT p_partkey AS uid, array_to_string(list_sort(list_distinct([lower(p_brand), p_type, 'extinct'])), ',') AS flags FROM part")
def flags_format(spark, d):
    raw = F.concat_ws(",", F.lower("p_brand"), "p_type", "p_type", F.lit(""))
    return table(spark, d, "part").select(F.col("p_partkey").alias("uid"), model.format_flags(model.add_flag(model.parse_flags(raw), "extinct")).alias("flags"))


@query(f"WITH {TX} SELECT rank, count(*) AS n, CAST(CASE rank WHEN 'kingdom' THEN 270 WHEN 'phylum' THEN 240 WHEN 'genus' THEN 70 WHEN 'species' THEN 30 END AS BIGINT) AS rank_num FROM tx GROUP BY rank")
def rank_num(spark, d):
    return tx(spark, d).groupBy("rank").agg(F.count("uid").alias("n")).withColumn("rank_num", model.rank_number(F.col("rank")).cast("long"))


@query("SELECT c_custkey AS uid, regexp_replace(c_name || ' ' || c_mktsegment, '[^-a-zA-Z0-9._]', '_', 'g') AS escaped FROM customer")
def escape_names(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("uid"), model.escape_odd(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("escaped"))


@query("SELECT event_id, strftime(make_timestamp(epoch_us(ts) // 1000000 * 1000000), '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def iso_times(spark, d):
    return table(spark, d, "events").select("event_id", model.iso_time(F.unix_timestamp("ts")).alias("iso"))


_BINOMIAL = "upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' || split_part(p_name, ' ', 2)"


def _species(p: DataFrame):
    genus = F.split_part("p_name", F.lit(" "), F.lit(1))
    return F.concat(F.upper(F.left(genus, F.lit(1))), F.substring(genus, 2, 1000), F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(2)))


@query(f"SELECT p_partkey AS uid, CASE WHEN p_size % 3 = 2 THEN {_BINOMIAL} || ' Putnam 1972' ELSE {_BINOMIAL} END AS canonical FROM part")
def canon_name(spark, d):
    p = table(spark, d, "part")
    ends = F.when(F.col("p_size") % 3 == 0, " (Linnaeus, 1758)").when(F.col("p_size") % 3 == 1, " de Vries").otherwise(" Putnam 1972")
    return p.select(F.col("p_partkey").alias("uid"), names.canonical(F.concat(_species(p), ends)).alias("canonical"))


@query(f"""SELECT p_partkey AS uid, CASE WHEN p_size % 3 = 0 THEN NULL ELSE split_part({_BINOMIAL}, ' ', 1) END AS genus,
CASE WHEN p_size % 3 = 1 THEN split_part(p_name, ' ', 2) WHEN p_size % 3 = 0 THEN NULL END AS epithet,
CASE WHEN p_size % 3 = 1 THEN 'species' ELSE 'clade' END AS apparent_rank, p_size % 3 = 2 AS undescribed FROM part""")
def name_parse(spark, d):
    p = table(spark, d, "part")
    genus = F.split_part(_species(p), F.lit(" "), F.lit(1))
    name = F.when(F.col("p_size") % 3 == 0, genus).when(F.col("p_size") % 3 == 1, _species(p)).otherwise(F.concat(genus, F.lit(" sp. XY12")))
    return p.select(F.col("p_partkey").alias("uid"), names.parsed(name).alias("x")).select("uid", "x.genus", F.col("x.sp_epithet").alias("epithet"), "x.apparent_rank", "x.undescribed")


@query("SELECT event_id, k AS predicate, json_extract_string(props, '$.' || k) AS object FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events) x")
def json_triples(spark, d):
    return readers.json_triples(table(spark, d, "events"), "event_id", "props")


@query("SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS link FROM pages")
def html_links(spark, d):
    return readers.html_links(table(spark, d, "pages"))


# --- reconcile

@query(f"WITH {SY} SELECT uid, name, syn_type FROM sy WHERE syn_type <> 'authority'")
def syn_interpret(spark, d):
    return reconcile.synonyms(sy(spark, d))


@query(f"WITH {TX}, {SY} SELECT t.uid, coalesce(string_agg(DISTINCT s.name, ',' ORDER BY s.name), '') AS synonyms FROM tx t LEFT JOIN sy s ON s.uid = t.uid GROUP BY t.uid")
def syn_attach(spark, d):
    return reconcile.attach_synonyms(tx(spark, d), sy(spark, d)).select("uid", listed("synonyms").alias("synonyms"))


@query(f"WITH {TX}, {SY}, k AS (SELECT uid, count(*) AS n FROM sy GROUP BY uid) SELECT name, t.uid, coalesce(n, 0) AS score FROM tx t LEFT JOIN k ON k.uid = t.uid WHERE rank = 'species'")
def findable_names(spark, d):
    return reconcile.findable_names(tx(spark, d), sy(spark, d)).withColumn("score", F.col("score").cast("long"))


# external taxa: orders of a later release; by their last digit species or subspecies here and there, by the digit before known by a synonym only
@query(f"""WITH {TX}, {TX2}, e AS (SELECT uid, name, right(uid, 1) AS d, substr(right(uid, 2), 1, 1) IN ('0', '2', '4', '6', '8') AS syn FROM tx2 WHERE rank = 'species'),
o AS (SELECT name FROM tx WHERE rank = 'species')
SELECT uid, CASE WHEN name IN (SELECT name FROM o) THEN concat(CASE WHEN syn THEN 'SYN' ELSE 'VALID' END, CASE WHEN d IN ('5', '6') THEN '_INF' ELSE '_SP' END, '_MAIN_VALID', CASE WHEN d IN ('6', '7') THEN '_INF' ELSE '_SP' END) END AS status,
CAST(CASE WHEN name IN (SELECT name FROM o) THEN 4 + CASE WHEN syn THEN 2 ELSE 1 END + CASE WHEN d IN ('5', '6') THEN 32 ELSE 16 END + CASE WHEN d IN ('6', '7') THEN 256 ELSE 128 END END AS BIGINT) AS code FROM e""")
def align_cascade(spark, d):
    t, e = tx(spark, d), tx2(spark, d)
    digit = F.right("uid", F.lit(1))
    low = lambda x, *digits: x.withColumn("rank", F.when((F.col("rank") == "species") & digit.isin(*digits), "subspecies").otherwise(F.col("rank")))
    hidden = (F.col("rank") == "species") & F.substring(F.right("uid", F.lit(2)), 1, 1).isin("0", "2", "4", "6", "8")
    syn = e.filter(hidden).select("uid", "name")
    ext = low(e.withColumn("name", F.when(hidden, F.concat(F.lit("x"), "name")).otherwise(F.col("name"))), "5", "6")
    return reconcile.match_cascade(ext, syn, low(t, "6", "7")).select("uid", "status", F.col("code").cast("long").alias("code"))


@query("""WITH a AS (SELECT p_name AS name, max(p_size % 2) = 1 AS v, count(*) AS n FROM part WHERE p_size < 25 GROUP BY 1), b AS (SELECT p_name AS name, max(p_size % 3) = 1 AS v, count(*) AS n FROM part WHERE p_size >= 25 GROUP BY 1)
SELECT coalesce(a.name, b.name) AS name, CASE WHEN a.v AND b.v THEN 'valid_in_both' WHEN a.v AND b.n = 1 THEN 'bijection_second_invalid' WHEN b.v AND a.n = 1 THEN 'bijection_first_invalid'
WHEN a.v AND b.n > 1 THEN 'first_ambiguous' WHEN b.v AND a.n > 1 THEN 'second_ambiguous' WHEN a.v THEN 'first_only' WHEN b.v THEN 'second_only' ELSE 'valid_in_neither' END AS category
FROM a FULL JOIN b ON a.name = b.name""")
def bipartition(spark, d):
    p = table(spark, d, "part")
    a = p.filter("p_size < 25").select(F.col("p_name").alias("name"), F.col("p_size") % 2)
    a = a.toDF("name", "m").select("name", (F.col("m") == 1).alias("is_valid"))
    b = p.filter("p_size >= 25").select(F.col("p_name").alias("name"), (F.col("p_size") % 3).alias("m"))
    top = b.groupBy("name").agg(F.max("m").alias("top"))
    return reconcile.bipartition(a, b.join(top, "name").select("name", (F.col("top") == 1).alias("is_valid")))


# every row of part makes an edge; with the size in both ends the graph falls into many small pieces of all classes
_EDGES = "e AS (SELECT DISTINCT concat(p_brand, '/', CAST(p_size AS VARCHAR(9))) AS main, concat(p_name, '/', CAST(p_size AS VARCHAR(9))) AS ref FROM part)"
_CLASSES = f"""{_EDGES}, g AS (SELECT main, ref, count(*) OVER (PARTITION BY main) AS nr, count(*) OVER (PARTITION BY ref) AS no FROM e),
h AS (SELECT *, max(nr) OVER (PARTITION BY ref) AS ar, max(no) OVER (PARTITION BY main) AS ao FROM g),
m AS (SELECT main, ref, CASE WHEN nr = 1 AND no = 1 THEN 'unique' WHEN nr = 1 AND ar = 1 THEN 'merge' WHEN nr > 1 AND ao = 1 THEN 'split' ELSE 'snarl' END AS class FROM h)"""


def _edges(spark, d):
    end = lambda c: F.concat(c, F.lit("/"), F.col("p_size").cast("string"))
    return table(spark, d, "part").select(end(F.col("p_brand")).alias("main"), end(F.col("p_name")).alias("ref"))


@query(f"WITH {_CLASSES} SELECT main, ref, class FROM m")
def map_partition(spark, d):
    return reconcile.map_classes(_edges(spark, d))


@query(f"""WITH {_CLASSES}, s AS (SELECT DISTINCT main, ref FROM m WHERE class = 'snarl'), k AS (SELECT DISTINCT list_sort(list_distinct(list(b.main))) AS members FROM s a JOIN s b ON a.ref = b.ref GROUP BY a.main)
SELECT array_to_string(members, ',') AS members FROM k x WHERE NOT EXISTS (SELECT 1 FROM k y WHERE len(y.members) > len(x.members) AND list_has_all(y.members, x.members))""")
def map_snarls(spark, d):
    return reconcile.snarls(reconcile.map_classes(_edges(spark, d))).select(F.array_join("members", ",").alias("members"))


# brands against types: few nodes, every one of them in one piece
_CLASSES_ALL = _CLASSES.replace(_EDGES, "e AS (SELECT DISTINCT p_brand AS main, p_type AS ref FROM part)")


def _edges_all(spark, d):
    return table(spark, d, "part").select(F.col("p_brand").alias("main"), F.col("p_type").alias("ref"))


@query(f"WITH {_CLASSES_ALL} SELECT main, ref, class FROM m")
def map_partition_all(spark, d):
    return reconcile.map_classes(_edges_all(spark, d))


@query(f"""WITH {_CLASSES_ALL}, k AS (SELECT DISTINCT members FROM (SELECT list_sort(list_distinct(list(b.main))) AS members FROM m a JOIN m b ON a.ref = b.ref WHERE a.class = 'snarl' AND b.class = 'snarl' GROUP BY a.main) z)
SELECT array_to_string(members, ',') AS members FROM k x WHERE NOT EXISTS (SELECT 1 FROM k y WHERE len(y.members) > len(x.members) AND list_has_all(y.members, x.members))""")
def map_snarls_all(spark, d):
    return reconcile.snarls(reconcile.map_classes(_edges_all(spark, d))).select(F.array_join("members", ",").alias("members"))


@query(f"""WITH RECURSIVE {TX}, {TX2}, {CL}, cl2 AS (SELECT uid AS des, uid AS anc, 0 AS dist FROM tx2 UNION ALL SELECT cl2.des, t.par_id, cl2.dist + 1 FROM cl2 JOIN tx2 t ON cl2.anc = t.uid WHERE t.par_id IS NOT NULL),
u AS (SELECT a.uid FROM tx a JOIN tx2 b ON a.uid = b.uid WHERE a.rank = 'species'),
x AS (SELECT DISTINCT t.name, cl.des FROM cl JOIN u ON u.uid = cl.des JOIN tx t ON t.uid = cl.anc WHERE dist > 0), y AS (SELECT DISTINCT t.name, cl2.des FROM cl2 JOIN u ON u.uid = cl2.des JOIN tx2 t ON t.uid = cl2.anc WHERE dist > 0)
SELECT name, count(*) FILTER (WHERE l IS NOT NULL AND r IS NOT NULL) AS n_shared, count(*) FILTER (WHERE r IS NULL) AS missing_in_ref, count(*) FILTER (WHERE l IS NULL) AS missing_in_main, bool_and(l IS NOT NULL AND r IS NOT NULL) AS same
FROM (SELECT coalesce(x.name, y.name) AS name, x.des AS l, y.des AS r FROM x FULL JOIN y ON x.name = y.name AND x.des = y.des) z
WHERE name IN (SELECT name FROM x) AND name IN (SELECT name FROM y) GROUP BY name""")
def clade_def(spark, d):
    a, b = tx(spark, d), tx2(spark, d)
    same = a.filter("rank = 'species'").select(F.col("uid").alias("main")).join(b.select(F.col("uid").alias("main")), "main", "left_semi")
    return reconcile.clade_definitions(a, b, same.withColumn("ref", F.col("main")))


# --- differences of releases

@query(f"""{DIFF} SELECT uid, CASE WHEN ou IS NULL AND uid NOT IN (SELECT par_id FROM k2) THEN 'NEW_TERMINAL' WHEN ou IS NULL THEN 'NEW_INTERNAL'
WHEN nu IS NULL AND uid NOT IN (SELECT par_id FROM k1) THEN 'DELETED_TERMINAL' WHEN nu IS NULL THEN 'DELETED_INTERNAL'
WHEN op IS DISTINCT FROM np AND onm IS DISTINCT FROM nnm THEN 'NAME_AND_PAR_CHANGED' WHEN op IS DISTINCT FROM np THEN 'PAR_CHANGED' WHEN onm IS DISTINCT FROM nnm THEN 'NAME_CHANGED'
WHEN ork IS DISTINCT FROM nrk THEN 'UNDIAGNOSED_CHANGE' ELSE 'UNCHANGED' END AS status FROM both_""")
def diff_status(spark, d):
    return diff.statuses(tx(spark, d), tx2(spark, d)).select("uid", "status")


@query(f"""{DIFF} SELECT uid, 'par_id' AS field, op AS old, np AS new FROM both_ WHERE ou IS NOT NULL AND nu IS NOT NULL AND op IS DISTINCT FROM np
UNION ALL SELECT uid, 'name', onm, nnm FROM both_ WHERE ou IS NOT NULL AND nu IS NOT NULL AND onm IS DISTINCT FROM nnm""")
def diff_fields(spark, d):
    return diff.field_changes(tx(spark, d), tx2(spark, d)).select("uid", "field", "old", "new")


@query(f"""{DIFF}, mv AS (SELECT uid, op, np FROM both_ WHERE op <> np), g AS (SELECT np AS par_id, count(*) AS n, string_agg(DISTINCT op, ',' ORDER BY op) AS t FROM mv GROUP BY np), l AS (SELECT op AS par_id, count(*) AS n, string_agg(DISTINCT np, ',' ORDER BY np) AS t FROM mv GROUP BY op)
SELECT coalesce(g.par_id, l.par_id) AS par_id, coalesce(g.n, 0) AS n_new, coalesce(l.n, 0) AS n_lost, coalesce(g.t, '') AS took_from, coalesce(l.t, '') AS lost_to FROM g FULL JOIN l ON g.par_id = l.par_id""")
def diff_children(spark, d):
    return diff.child_transfers(tx(spark, d), tx2(spark, d)).withColumn("took_from", listed("took_from")).withColumn("lost_to", listed("lost_to"))


@query(f"""{DIFF}, a AS (SELECT par_id AS genus, uid, name FROM tx WHERE rank = 'species'), b AS (SELECT par_id AS genus, uid, name FROM tx2 WHERE rank = 'species')
SELECT coalesce(a.genus, b.genus) AS genus, count(*) FILTER (WHERE a.name = b.name) AS retained, count(*) FILTER (WHERE a.name <> b.name) AS modified, count(*) FILTER (WHERE a.uid IS NULL) AS added, count(*) FILTER (WHERE b.uid IS NULL) AS deleted
FROM a FULL JOIN b ON a.genus = b.genus AND a.uid = b.uid GROUP BY 1""")
def diff_genus_report(spark, d):
    return diff.genus_report(tx(spark, d), tx2(spark, d))


# every eighteenth genus has lost its species before, the other ninths lose theirs now
@query(f"""{DIFF}, p1 AS (SELECT DISTINCT par_id FROM tx WHERE rank = 'species' AND CAST(substr(par_id, 2) AS BIGINT) % 18 <> 0), p2 AS (SELECT DISTINCT par_id FROM tx2 WHERE rank = 'species' AND CAST(substr(par_id, 2) AS BIGINT) % 9 <> 0)
SELECT uid, CASE WHEN uid IN (SELECT par_id FROM p1) THEN 'newly_barren' ELSE 'oldly_barren' END AS kind FROM tx2 WHERE rank = 'genus' AND uid NOT IN (SELECT par_id FROM p2)""")
def diff_barren(spark, d):
    without = lambda t, n: t.filter((F.col("rank") != "species") | (F.expr("try_cast(substr(par_id, 2) AS BIGINT)") % n != 0))
    return diff.barren(without(tx(spark, d), 18), without(tx2(spark, d), 9))


# every customer and its orders renamed alike
@query("SELECT 'o' || o_orderkey AS uid, c_name || ' #' || o_orderkey AS old, 'New ' || c_name || ' #' || o_orderkey AS new FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 7 = 0")
def diff_rename_cascade(spark, d):
    c = table(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("uid"), F.lit(None).cast("string").alias("par_id"), F.col("c_name").alias("name"), (F.col("c_custkey") % 7 == 0).alias("hit"))
    o = table(spark, d, "orders").join(c.select(F.col("uid").alias("par_id"), F.col("name").alias("g"), "hit"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")) == F.col("par_id"))
    o = o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("uid"), "par_id", F.concat("g", F.lit(" #"), F.col("o_orderkey").cast("string")).alias("name"), "hit")
    prev = c.unionByName(o)
    curr = prev.withColumn("name", F.when(F.col("hit"), F.concat(F.lit("New "), "name")).otherwise(F.col("name")))
    return diff.cascading_renames(prev.drop("hit"), curr.drop("hit"))


@query(f"""WITH {SY}, sy2 AS (SELECT uid, name, CASE WHEN right(uid, 1) = '2' THEN 'includes' ELSE syn_type END AS syn_type FROM sy WHERE right(uid, 1) <> '1'),
a AS (SELECT uid, name, string_agg(DISTINCT syn_type, ',' ORDER BY syn_type) AS t FROM sy GROUP BY uid, name), b AS (SELECT uid, name, string_agg(DISTINCT syn_type, ',' ORDER BY syn_type) AS t FROM sy2 GROUP BY uid, name)
SELECT uid, name, change FROM (SELECT coalesce(a.uid, b.uid) AS uid, coalesce(a.name, b.name) AS name, CASE WHEN b.t IS NULL THEN 'deleted' WHEN a.t IS NULL THEN 'added' WHEN a.t <> b.t THEN 'changed' END AS change FROM a FULL JOIN b ON a.uid = b.uid AND a.name = b.name) z WHERE change IS NOT NULL""")
def diff_synonyms(spark, d):
    s = sy(spark, d)
    later = s.filter("right(uid, 1) <> '1'").withColumn("syn_type", F.when(F.right("uid", F.lit(1)) == "2", "includes").otherwise(F.col("syn_type")))
    return diff.synonym_changes(s, later)


# --- separators and graph

@query(f"{HEAD}, k AS (SELECT anc AS uid, count(*) AS n_tips FROM cl JOIN tips ON tips.uid = cl.des GROUP BY anc) SELECT t.uid, t.name, n_tips FROM tx t JOIN k ON k.uid = t.uid WHERE n_tips >= 20 AND t.par_id IS NOT NULL AND t.rank <> 'species' AND t.uid NOT IN (SELECT uid FROM tips)")
def sep_candidates(spark, d):
    return separators.candidates(tx(spark, d))


# without two kingdoms and every fourth phylum, so that the confirmed ones lie on several levels
@query(f"""{HEAD}, k AS (SELECT anc AS uid, count(*) AS n_tips FROM cl JOIN tips ON tips.uid = cl.des GROUP BY anc),
s AS (SELECT t.uid FROM tx t JOIN k ON k.uid = t.uid WHERE n_tips >= 20 AND t.par_id IS NOT NULL AND t.rank <> 'species' AND t.uid NOT IN (SELECT uid FROM tips) AND t.uid NOT IN ('r0', 'r2') AND NOT (t.rank = 'phylum' AND CAST(substr(t.uid, 2) AS BIGINT) % 4 = 0))
SELECT uid FROM s WHERE NOT EXISTS (SELECT 1 FROM cl JOIN s x ON x.uid = cl.anc WHERE cl.des = s.uid AND cl.dist > 0)""")
def sep_confirmed(spark, d):
    t = tx(spark, d)
    fourth = F.col("uid").startswith("n") & (F.expr("try_cast(substr(uid, 2) AS BIGINT)") % 4 == 0)
    return separators.confirmed(t, separators.candidates(t).filter(~F.col("uid").isin("r0", "r2") & ~fourth)).select("uid")


@query(f"""{HEAD}, k AS (SELECT anc AS uid, count(*) AS n_tips FROM cl JOIN tips ON tips.uid = cl.des GROUP BY anc),
s AS (SELECT t.uid FROM tx t JOIN k ON k.uid = t.uid WHERE n_tips >= 20 AND t.par_id IS NOT NULL AND t.rank <> 'species' AND t.uid NOT IN (SELECT uid FROM tips)),
up AS (SELECT cl.des AS uid, arg_min(cl.anc, cl.dist) AS parent FROM cl JOIN s ON s.uid = cl.anc WHERE cl.dist > 0 GROUP BY cl.des),
n AS (SELECT s.uid, up.parent, count(*) OVER (PARTITION BY up.parent) AS n FROM s LEFT JOIN up ON up.uid = s.uid)
SELECT uid, parent FROM n WHERE parent IS NULL OR n > 1""")
def sep_nested(spark, d):
    t = tx(spark, d)
    return separators.nested(t, separators.candidates(t))


@query("SELECT src, n FROM (SELECT lower(p_brand) AS src, count(*) AS n FROM part GROUP BY 1) x")
def sep_sources(spark, d):
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("uid"), model.parse_sources(F.concat(F.lower("p_brand"), F.lit(":1,additions7:2,https:3"))).alias("src"))
    return separators.relevant_sources(rows)


@query(f"WITH {TX}, {SY} SELECT uid, uid || ':type' AS type_id FROM tx WHERE rank = 'species' AND uid NOT IN (SELECT uid FROM sy WHERE syn_type = 'authority')")
def sem_type_impute(spark, d):
    s = sy(spark, d).withColumn("syn_type", F.when(F.col("syn_type") == "authority", "type material").otherwise(F.col("syn_type")))
    return semgraph.impute_types(tx(spark, d), s)


@query("SELECT uid, CASE WHEN n = 1 THEN base ELSE base || ':v' || n END AS id FROM (SELECT CAST(p_partkey AS VARCHAR) AS uid, 'p:' || p_name AS base, row_number() OVER (PARTITION BY p_name ORDER BY CAST(p_partkey AS VARCHAR)) AS n FROM part) x")
def sem_minted_ids(spark, d):
    return semgraph.minted(table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("uid"), F.concat(F.lit("p:"), "p_name").alias("base"))).select("uid", "id")


@query("SELECT CASE WHEN count(*) OVER (PARTITION BY epithet) > 1 THEN epithet || '|' || authority ELSE epithet END AS node, epithet, authority FROM (SELECT DISTINCT p_name AS epithet, p_brand AS authority FROM part) x")
def sem_homonyms(spark, d):
    return semgraph.split_homonyms(table(spark, d, "part").select(F.col("p_name").alias("epithet"), F.col("p_brand").alias("authority")))


@query(f"WITH s AS (SELECT DISTINCT {_BINOMIAL} AS name, split_part({_BINOMIAL}, ' ', 1) AS g, split_part(p_name, ' ', 2) AS e FROM part) SELECT 'genus_group' AS class, NULL AS context, g AS name FROM s UNION SELECT 'species_group', g, e FROM s UNION SELECT 'combination', NULL, name FROM s UNION SELECT 'verbatim', NULL, name FROM s")
def sem_name_nodes(spark, d):
    p = table(spark, d, "part")
    rows = p.select(F.col("p_partkey").cast("string").alias("uid"), F.lit(None).cast("string").alias("par_id"), F.lit("species").alias("rank"), _species(p).alias("name"))
    return semgraph.name_nodes(semgraph.concepts(rows))


@query(f"WITH RECURSIVE {TX}, {CL}, {_WALK}, o AS (SELECT uid, row_number() OVER (ORDER BY path) AS i FROM w) SELECT cl.anc AS id, arg_max(cl.des, o.i) AS terminal FROM cl JOIN o ON o.uid = cl.des GROUP BY cl.anc")
def resource_terminal(spark, d):
    return catalog.terminal(tx(spark, d).select(F.col("uid").alias("id"), F.col("par_id").alias("base")))
