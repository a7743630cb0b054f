"""Queries on the driver's tables, one or more for each operator family, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions import scalar as S
from tagweave.functions import vectors as V
from tagweave.operators import aggregates as A
from tagweave.operators import joins as J
from tagweave.operators import windows as W
from tagweave.plans import lang as L
from tagweave.plans.algebra import Domain, Relation, tags
from tagweave.plans.compile import Bindings, Compiler, evaluate, implies_column
from tagweave.plans.lang import Problem, scene
from tagweave.sources.tables import database, entities, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


SUPPORTED, TOUCHING, COPLANAR = Relation("supported_by"), Relation("touching"), Relation("coplanar")


def members(spark, sf, objs, key: str) -> DataFrame:
    """The keys of a set's members."""
    rows = Compiler(database(spark, sf)).members(objs)
    return rows.select(F.split_part("name", F.lit(":"), F.lit(2)).cast("bigint").alias(key))


# set filters ---------------------------------------------------------------------------------------


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND NOT o_orderpriority = '5-LOW'")
def tagged_pos_neg(spark, sf):
    return members(spark, sf, scene()["order"]["status-F", "-5-LOW"], "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'")
def tagged_any(spark, sf):
    return members(spark, sf, scene()["order"].union("status-P", "1-URGENT"), "o_orderkey")


@query("SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'")
def excludes(spark, sf):
    return members(spark, sf, scene()["customer"].excludes("BUILDING"), "c_custkey")


# relations -----------------------------------------------------------------------------------------


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')")
def related_to_semi(spark, sf):
    return members(spark, sf, scene()["order"].related_to(scene()["customer", "BUILDING"], SUPPORTED), "o_orderkey")


@query("""SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND EXISTS (
  SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND EXISTS (SELECT 1 FROM region WHERE r_regionkey = n_regionkey AND r_regionkey = 2)))""")
def related_to_nested(spark, sf):
    db = database(spark, sf)
    regions = table(spark, sf, "region").where("r_regionkey = 2")
    marked = entities(regions, "region", "r_regionkey", [F.lit("chosen")])
    db = Bindings(db.objects.where("class <> 'region'").union(marked), db.relations, db.classes)
    objs = scene()["order"].related_to(scene()["customer"].related_to(scene()["nation"].related_to(scene()["region", "chosen"], COPLANAR), TOUCHING), SUPPORTED)
    return Compiler(db).members(objs).select(F.split_part("name", F.lit(":"), F.lit(2)).cast("bigint").alias("o_orderkey"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def not_related_anti(spark, sf):
    db = database(spark, sf)
    back = db.relations.where("kind = 'supported_by'").select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit("touching").alias("kind"))
    rows = Compiler(Bindings(db.objects, back, db.classes)).members(scene().in_domain(Domain(tags("customer"), ((-TOUCHING, Domain(tags("order", "status-P"))),))))
    return rows.select(F.split_part("name", F.lit(":"), F.lit(2)).cast("bigint").alias("c_custkey"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'
  AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')
  AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'MACHINERY')""")
def domain_contains_mixed(spark, sf):
    domain = Domain(tags("order", "status-F"), ((SUPPORTED, Domain(tags("customer", "-BUILDING"))), (-SUPPORTED, Domain(tags("customer", "MACHINERY")))))
    return members(spark, sf, scene().in_domain(domain), "o_orderkey")


@query("""SELECT 'n' AS name, 'loss' AS kind, count(*)::DOUBLE AS value FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
  OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def or_of_relations(spark, sf):
    has = lambda c, t: scene()["order", t].related_to(c, SUPPORTED).count() >= 1
    return evaluate(Problem({}, {"n": scene()["customer"].sum(lambda c: has(c, "status-P") + has(c, "1-URGENT"))}), database(spark, sf))


@query("""WITH e AS (SELECT 'touching' AS kind, c_custkey AS k FROM customer UNION ALL SELECT 'touching', s_suppkey FROM supplier UNION ALL SELECT 'supported_by', o_orderkey FROM orders UNION ALL SELECT 'coplanar', n_nationkey FROM nation)
SELECT t.asked, count(*)::BIGINT AS n FROM e JOIN (VALUES ('any','touching'),('any','supported_by'),('any','coplanar'),('touching','touching'),('supported_by','touching'),('supported_by','supported_by'),('coplanar','coplanar')) t(asked, kind) USING (kind) GROUP BY 1""")
def relation_subtype_implies(spark, sf):
    db = database(spark, sf)
    edges = db.relations
    parts = [edges.where(implies_column(Relation(k), edges)).agg(F.count("*").alias("n")).select(F.lit(k).alias("asked"), "n") for k in ("any", "touching", "supported_by", "coplanar")]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


# quantifiers and violations ------------------------------------------------------------------------


@query("""SELECT 'slice' AS name, 'violation' AS kind, sum(greatest(5 - c, c - 30, 0))::DOUBLE AS value FROM (
  SELECT n_nationkey, count(o_orderkey) AS c FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING'
  LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderpriority <> '5-LOW' GROUP BY 1)""")
def minimum_slice(spark, sf):
    picked = scene()["order", "status-F", "-5-LOW"]
    body = lambda n: picked.related_to(scene()["customer", "BUILDING"].related_to(n, TOUCHING), SUPPORTED).count().in_range(5, 30)
    return evaluate(Problem({"slice": scene()["nation"].all(body)}), database(spark, sf))


@query("""SELECT 'n' AS name, 'violation' AS kind, sum(greatest(50 - c, c - 60, 0))::DOUBLE AS value FROM (
  SELECT n_nationkey, count(c_custkey) AS c FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1)""")
def count_in_range_violation(spark, sf):
    e = scene()["nation"].all(lambda n: scene()["customer"].related_to(n, TOUCHING).count().in_range(50, 60))
    return evaluate(Problem({"n": e}), database(spark, sf))


@query("""SELECT 'c' AS name, 'violation' AS kind, sum(greatest(3 - f, 0) + least(greatest(p - 1, 0), greatest(2 - u, 0)) + CASE WHEN u >= 4 THEN 1 ELSE 0 END)::DOUBLE AS value FROM (
  SELECT c_custkey, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'P') AS p, count(*) FILTER (o_orderpriority = '1-URGENT') AS u
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)""")
def forall_conjunction_violation(spark, sf):
    def body(c):
        of = lambda t: scene()["order", t].related_to(c, SUPPORTED).count()
        return (of("status-F") >= 3) * ((of("status-P") <= 1) + (of("1-URGENT") >= 2)) * ~(of("1-URGENT") >= 4)

    return evaluate(Problem({"c": scene()["customer"].all(body)}), database(spark, sf))


@query("""SELECT 'm' AS name, 'loss' AS kind, round(coalesce(avg(v), 0), 6)::DOUBLE AS value FROM (
  SELECT r_regionkey, coalesce(avg(c), 0) AS v FROM region LEFT JOIN (
    SELECT n_nationkey, n_regionkey, count(s_suppkey) AS c FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2) ON n_regionkey = r_regionkey GROUP BY 1)""")
def mean_over_nested(spark, sf):
    inner = lambda r: scene()["nation"].related_to(r, COPLANAR).mean(lambda n: scene()["supplier"].related_to(n, TOUCHING).count())
    return evaluate(Problem({}, {"m": scene()["region"].mean(inner)}), database(spark, sf)).withColumn("value", F.round("value", 6))


@query("""SELECT 'h' AS name, 'loss' AS kind, round(sum(greatest(100000 - t, t - 500000, 0)), 2)::DOUBLE AS value FROM (
  SELECT c_custkey, coalesce(sum(o_totalprice), 0) AS t FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)""")
def sum_over_hinge(spark, sf):
    e = scene()["customer"].sum(lambda c: scene()["order"].related_to(c, SUPPORTED).total("amount").hinge(100000.0, 500000.0))
    return evaluate(Problem({}, {"h": e}), database(spark, sf)).withColumn("value", F.round("value", 2))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount) + l_tax, 6) AS a, round(abs(l_quantity - 25), 6) AS b,
  round(pow(l_discount, 2), 6) AS c, round(ln(l_quantity), 6) AS d, least(greatest(l_quantity, 10), 40) AS e, -l_quantity AS f,
  round(CASE WHEN l_discount = 0 THEN CASE WHEN l_tax = 0 THEN 0 ELSE 1 END ELSE l_tax / l_discount END, 6) AS g FROM lineitem""")
def scalar_algebra(spark, sf):
    q, p, d, t = (F.col(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(p * (1 - d) + t, 6).alias("a"), F.round(F.abs(q - 25), 6).alias("b"), F.round(F.pow(d, 2), 6).alias("c"),
        F.round(F.ln(q), 6).alias("d"), S.clip(q, 10.0, 40.0).alias("e"), (-q).alias("f"), F.round(S.safediv(t, d), 6).alias("g"),
    )


@query("""SELECT p_partkey, round(CASE WHEN n = 0 THEN CASE WHEN r = 0 THEN 0 ELSE 1 END ELSE r / n END, 6)::DOUBLE AS fullness FROM (
  SELECT p_partkey, count(l_partkey)::DOUBLE AS n, count(*) FILTER (l_returnflag = 'R')::DOUBLE AS r FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY 1)""")
def safediv_fullness(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_returnflag") == "R").alias("r"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    return table(spark, sf, "part").join(lines, F.col("p_partkey") == F.col("l_partkey"), "left").select("p_partkey", F.round(S.safediv(zero("r"), zero("n")), 6).alias("fullness"))


@query("""SELECT l_returnflag, round(sum(d[1] * d[2] + 1e-10), 2)::DOUBLE AS volume FROM (SELECT l_returnflag, list_reverse_sort([l_quantity, l_discount * 100, l_tax * 100]) AS d FROM lineitem) GROUP BY 1""")
def volume_topdims(spark, sf):
    from tagweave.plans.compile import volume_of

    dims = F.array("l_quantity", F.col("l_discount") * 100, F.col("l_tax") * 100)
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum(volume_of(dims, 2)), 2).alias("volume"))


def scorecard() -> Problem:
    """A program over customers, suppliers and orders: two constraints and three terms."""
    per_nation = scene()["nation"].all(lambda n: (scene()["customer"].related_to(n, TOUCHING).count() >= 50) * (scene()["supplier"].related_to(n, TOUCHING).count() >= 1))
    loyal = scene()["customer", "BUILDING"].all(lambda c: scene()["order"].related_to(c, SUPPORTED).count().in_range(5, 15))
    urgent = scene()["customer"].mean(lambda c: scene()["order", "1-URGENT"].related_to(c, SUPPORTED).count().safediv(scene()["order"].related_to(c, SUPPORTED).count()))
    poor = scene()["supplier"].sum(lambda s: s.total("amount").hinge(0.0, 1e9).minimize(0.5))
    return Problem({"per_nation": per_nation, "loyal": loyal}, {"urgent": urgent, "poor": poor, "orders": scene()["order"].count().maximize(1)})


SCORECARD_SQL = """WITH c AS (SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS k, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS s FROM nation),
o AS (SELECT c_custkey, any_value(c_mktsegment) AS seg, count(o_orderkey) AS n, count(*) FILTER (o_orderpriority = '1-URGENT') AS u FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT 'per_nation' AS name, 'violation' AS kind, (SELECT sum(greatest(50 - k, 0) + greatest(1 - s, 0)) FROM c)::DOUBLE AS value
UNION ALL SELECT 'loyal', 'violation', (SELECT sum(greatest(5 - n, n - 15, 0)) FROM o WHERE seg = 'BUILDING')::DOUBLE
UNION ALL SELECT 'urgent', 'loss', round((SELECT avg(CASE WHEN n = 0 THEN 0 ELSE u / n END) FROM o), 6)::DOUBLE
UNION ALL SELECT 'poor', 'loss', round((SELECT sum(greatest(0 - s_acctbal, 0) * 0.5) FROM supplier), 6)::DOUBLE
UNION ALL SELECT 'orders', 'loss', (SELECT -count(*) FROM orders)::DOUBLE"""


@query(SCORECARD_SQL)
def problem_scorecard(spark, sf):
    return evaluate(scorecard(), database(spark, sf)).withColumn("value", F.round("value", 6))


@query("""WITH t AS (SELECT c_custkey % 4 AS candidate, count(*) AS n FROM customer, range(0, 4) GROUP BY 1)
SELECT k AS candidate, (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')::DOUBLE AS before,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 4 <> k)::DOUBLE AS after FROM range(0, 4) r(k)""")
def loss_before_after_delta(spark, sf):
    from tagweave.plans.solver import scored_deletions

    orders = table(spark, sf, "orders").where("o_orderstatus = 'P'")
    return scored_deletions(orders, F.col("o_orderkey") % 4, F.lit(1.0), spark.range(4).select(F.col("id").alias("candidate")))


@query("SELECT l_returnflag, count(DISTINCT trunc((l_extendedprice - 20000) / 1000))::BIGINT AS lines FROM lineitem GROUP BY 1")
def grid_line_count(spark, sf):
    return A.grid_line_count(table(spark, sf, "lineitem"), ["l_returnflag"], F.col("l_extendedprice") - 20000, 1000.0)


@query("""SELECT n_nationkey, round(CASE c WHEN 0 THEN -ln(0.2 + 1e-20) WHEN 1 THEN -ln(0.3 + 1e-20) WHEN 2 THEN -ln(0.5 + 1e-20) ELSE -ln(1e-100) END, 6)::DOUBLE AS nll FROM (
  SELECT n_nationkey, count(s_suppkey) AS c FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1)""")
def nll_rand(spark, sf):
    of = lambda n: scene()["supplier"].related_to(n, TOUCHING).count().rand("cat", [0.2, 0.3, 0.5])
    out = Compiler(database(spark, sf)).for_each(scene()["nation"], of)
    return out.select(F.split_part("name", F.lit(":"), F.lit(2)).cast("int").alias("n_nationkey"), F.round("value", 6).alias("nll"))


# aggregations --------------------------------------------------------------------------------------


@query("SELECT left(text, 12) AS value, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def value_counts_prefix(spark, sf):
    return A.value_counts(table(spark, sf, "documents"), S.short_reason(F.col("text"), 12))


@query("""SELECT l_returnflag, count(*)::BIGINT AS n, round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.9), 4) AS p90,
  round(quantile_cont(l_extendedprice, 0.95), 4) AS p95, round(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM lineitem GROUP BY 1""")
def stage_quantiles(spark, sf):
    return A.quantiles(table(spark, sf, "lineitem"), ["l_returnflag"], F.col("l_extendedprice"), 4)


@query("""SELECT o_custkey AS seed, max(l_extendedprice) AS max_mem, round(sum(l_quantity), 4) AS seconds, round(sum(l_quantity * l_linenumber), 4) AS cpu_seconds,
  round(coalesce(sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity * l_linenumber END), 0), 4) AS gpu_seconds FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def group_resources(spark, sf):
    jobs = table(spark, sf, "orders").join(table(spark, sf, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    gpus = F.when(F.col("l_returnflag") != "N", F.col("l_linenumber"))
    out = A.scene_resources(jobs.select(F.col("o_custkey").alias("seed"), F.col("l_extendedprice").alias("mem"), F.col("l_quantity").alias("elapsed"), F.col("l_linenumber").alias("cpus"), gpus.alias("gpus")))
    return out.select("seed", "max_mem", *[F.round(c, 4).alias(c) for c in ("seconds", "cpu_seconds", "gpu_seconds")])


@query("""SELECT user_id, min(ts) FILTER (event_type IN ('signup', 'view')) AS begun, max(ts) FILTER (event_type = 'purchase') AS ended FROM events GROUP BY 1""")
def makespan_share(spark, sf):
    return A.makespan(table(spark, sf, "events"), ["user_id"], F.col("ts"), F.col("ts"), F.col("event_type").isin("signup", "view"), F.col("event_type") == "purchase")


@query("SELECT event_type, count(*)::BIGINT AS n, round(sum(value), 4)::DOUBLE AS total, round(100 * sum(value) / sum(sum(value)) OVER (), 4)::DOUBLE AS percent FROM events GROUP BY 1")
def stage_share(spark, sf):
    return A.shares(table(spark, sf, "events"), ["event_type"], F.col("value"), digits=4)


@query("SELECT o_orderstatus, o_orderpriority, count(*)::BIGINT AS n, grouping(o_orderpriority)::INT AS level FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus))")
def status_grouping_sets(spark, sf):
    return A.two_level_counts(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query("""SELECT count(*) FILTER (contains(x, 'Program A'))::BIGINT AS n_a, count(*) FILTER (contains(x, 'Program B'))::BIGINT AS n_b,
  count(*) FILTER (contains(x, 'Program A')) / count(*)::DOUBLE AS share_a FROM (SELECT CASE WHEN quality = 1 THEN 'Program A' ELSE 'Program B' END AS x FROM labels)""")
def ab_proportion(spark, sf):
    label = F.when(F.col("quality") == 1, "Program A").otherwise("Program B")
    return A.proportion(table(spark, sf, "labels"), label, "Program A", "Program B")


@query("SELECT (count(*) FILTER (toxic = 1))::DOUBLE / count(*) FILTER (NOT (toxic = 0 AND quality = 0)) AS rate FROM labels")
def survey_error_rate(spark, sf):
    label = F.when(F.col("toxic") == 1, "Yes").when(F.col("quality") == 0, "Not Sure").otherwise("No")
    return A.error_rate(table(spark, sf, "labels"), label)


@query("""SELECT k AS lang, coalesce(n, 0)::BIGINT AS n, coalesce(n / (SELECT count(*) FROM documents), 0)::DOUBLE AS share
  FROM (VALUES ('en'), ('de'), ('fr'), ('es'), ('xx')) d(k) LEFT JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY 1) ON lang = k""")
def tag_share_zero_filled(spark, sf):
    names = spark.createDataFrame([(x,) for x in ("en", "de", "fr", "es", "xx")], "lang string")
    return A.zero_filled_share(table(spark, sf, "documents"), "lang", names)


@query("""SELECT split_part(split_part(split_part(x, '(', 1), ':', -1), '.', 1) AS grp, round(sum(p_retailprice), 4)::DOUBLE AS total, count(*)::BIGINT AS n
  FROM (SELECT p_retailprice, p_brand || ':' || replace(p_type, ' ', '.') || '(' || p_size || ')' AS x FROM part) GROUP BY 1""")
def regroup_prefix_chain(spark, sf):
    name = F.concat("p_brand", F.lit(":"), F.replace("p_type", F.lit(" "), F.lit(".")), F.lit("("), F.col("p_size").cast("string"), F.lit(")"))
    return A.regrouped(table(spark, sf, "part"), name, F.col("p_retailprice")).withColumn("total", F.round("total", 4))


@query("SELECT user_id, CASE WHEN count(v) = count(*) THEN round(avg(v), 6) END AS score FROM (SELECT user_id, CASE WHEN event_type <> 'error' OR value > 20 THEN value END AS v FROM events) GROUP BY 1")
def complete_mean(spark, sf):
    v = F.when((F.col("event_type") != "error") | (F.col("value") > 20), F.col("value"))
    return A.complete_mean(table(spark, sf, "events").select("user_id", v.alias("v")), ["user_id"], "v").withColumn("score", F.round("score", 6))


@query("SELECT least(floor(l_discount * 100 / 10 * 100), 99)::INT AS bin, count(*)::BIGINT AS n FROM lineitem WHERE l_discount * 100 BETWEEN 0 AND 10 GROUP BY 1")
def depth_histogram(spark, sf):
    return A.histogram(table(spark, sf, "lineitem"), F.col("l_discount") * 100, 0.0, 10.0, 100)


@query("""SELECT o_orderstatus AS grp, min(year(o_orderdate))::INT AS x_min, max(year(o_orderdate))::INT AS x_max, min(month(o_orderdate))::INT AS y_min, max(month(o_orderdate))::INT AS y_max, count(*)::BIGINT AS n FROM orders GROUP BY 1""")
def instance_boxes_2d(spark, sf):
    return A.boxes_2d(table(spark, sf, "orders").select(F.col("o_orderstatus").alias("grp"), F.year("o_orderdate").alias("x"), F.month("o_orderdate").alias("y")), ["grp"])


# joins ---------------------------------------------------------------------------------------------


@query("""SELECT name, a.total AS total_A, b.total AS total_B FROM (SELECT o_custkey AS name, round(sum(o_totalprice), 4) AS total FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) a
  FULL OUTER JOIN (SELECT o_custkey AS name, round(sum(o_totalprice), 4) AS total FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) b USING (name)""")
def run_compare_outer(spark, sf):
    per = lambda cond: table(spark, sf, "orders").where(cond).groupBy(F.col("o_custkey").alias("name")).agg(F.round(F.sum("o_totalprice"), 4).alias("total"))
    return J.compared(per("o_orderstatus = 'P'"), per("o_orderpriority = '1-URGENT'"), "name")


@query("""SELECT e.event_id, e.user_id, e.ts, p.ts AS prev_ts, p.event_id AS prev_event_id FROM (SELECT * FROM events WHERE event_type = 'purchase') e
  ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') p ON e.user_id = p.user_id AND e.ts > p.ts""")
def asof_prev_event(spark, sf):
    events = table(spark, sf, "events")
    bought = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return J.asof(bought, events.where("event_type = 'view'"), ["user_id"], "ts", ["event_id"])


@query("SELECT event_id, user_id, lead(event_id) OVER w AS next_event_id, lead(event_type) OVER w AS next_event_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def next_frame_self_join(spark, sf):
    return J.shifted_pairs(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "event_type"]).select("event_id", "user_id", "next_event_id", "next_event_type")


@query("SELECT a.n_nationkey AS n_nationkey_a, b.n_nationkey AS n_nationkey_b, a.n_regionkey AS n_regionkey_a, b.n_regionkey AS n_regionkey_b FROM nation a, nation b WHERE a.n_nationkey <> b.n_nationkey AND a.n_regionkey = b.n_regionkey")
def pairwise_exclude_self(spark, sf):
    return J.pairs_of_distinct(table(spark, sf, "nation"), "n_nationkey", [], on=["n_regionkey"])


@query("""WITH i AS (SELECT p_partkey AS k, p_retailprice AS low, p_retailprice + p_size / 10.0 AS high FROM part)
SELECT a.k AS key_a, b.k AS key_b FROM i a, i b WHERE a.low <= b.high AND b.low <= a.high AND a.k < b.k""")
def bbox_overlap_join(spark, sf):
    i = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_retailprice").alias("low"), (F.col("p_retailprice") + F.col("p_size") / F.lit(10.0)).alias("high"))
    return J.interval_overlap(i, i, "k", "k", "low", "high", 5.0, once=True).select("key_a", "key_b")


@query("SELECT o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 3")
def relational_division(spark, sf):
    return J.divided(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query("""SELECT o_custkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 2
  EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'""")
def generator_lookup(spark, sf):
    return J.usable(table(spark, sf, "orders"), "o_custkey", "o_orderpriority", ["1-URGENT", "2-HIGH"], ["5-LOW"])


@query("""SELECT u AS user_id, d AS day FROM (SELECT DISTINCT user_id AS u FROM events), range(1, 31) r(d) WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = u AND day(ts) = d)""")
def missing_grid_anti(spark, sf):
    events = table(spark, sf, "events").select("user_id", F.dayofmonth("ts").cast("bigint").alias("day")).distinct()
    grid = events.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(30).cast("bigint"))).alias("day"))
    return J.not_in(grid, events, ["user_id", "day"])


@query("""WITH RECURSIVE e AS (SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier),
c AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM e UNION ALL SELECT c.node, e.parent, c.depth + 1 FROM c JOIN e ON c.ancestor = e.child)
SELECT node, ancestor, min(depth)::INT AS depth FROM c GROUP BY 1, 2""")
def ancestor_closure(spark, sf):
    nation, supplier = table(spark, sf, "nation"), table(spark, sf, "supplier")
    name = lambda k, c: F.concat(F.lit(k), F.col(c).cast("string"))
    edges = nation.select(name("n", "n_nationkey").alias("child"), name("r", "n_regionkey").alias("parent")).union(supplier.select(name("s", "s_suppkey"), name("n", "s_nationkey")))
    return J.ancestors(edges)


@query("""SELECT n_nationkey, s_suppkey FROM (SELECT n_nationkey, s_suppkey, row_number() OVER (PARTITION BY n_nationkey ORDER BY s_suppkey) AS k FROM nation JOIN supplier ON s_nationkey = n_nationkey) WHERE k <= 2 AND n_nationkey IN (SELECT n_nationkey FROM nation ORDER BY 1 LIMIT 2)""")
def assignment_product_limit(spark, sf):
    nations, suppliers = table(spark, sf, "nation").select("n_nationkey"), table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    return J.assignments([("n_nationkey", nations, None), ("s_suppkey", suppliers, F.col("s_nationkey") == F.col("n_nationkey"))], 2).select("n_nationkey", "s_suppkey")


_MISSPELT = "left(c_name, (c_custkey % 18)::INT) || substr(c_name, (c_custkey % 18)::INT + 2)"


@query(f"""WITH l AS (SELECT c_custkey, {_MISSPELT} AS name FROM customer)
SELECT l.c_custkey, min(r.c_name) AS match, round(any_value(200.0::DOUBLE * 17 / 35), 4) AS score FROM l JOIN customer r ON length(r.c_name) = 18 AND levenshtein(l.name, r.c_name) = 1 GROUP BY 1""")
def fuzzy_merge(spark, sf):
    """Names that have lost a character, each at a place of its own: the names that are one insertion away are the most alike."""
    k, name = F.col("c_custkey") % 18, F.col("c_name")
    short = F.concat(F.left(name, k.cast("int")), F.substring(name, (k + 2).cast("int"), F.lit(18)))
    c = table(spark, sf, "customer")
    left = c.select("c_custkey", short.alias("name"))
    return J.best_match(left, c.select(F.col("c_name").alias("name")), "name").select("c_custkey", "match", F.round("score", 4).alias("score"))


@query("""WITH b AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
d AS (SELECT a.vec_id AS point, c.vec_id AS other, sqrt((a.x - c.x) * (a.x - c.x) + (a.y - c.y) * (a.y - c.y) + (a.z - c.z) * (a.z - c.z)) AS d FROM b a, b c WHERE a.vec_id <> c.vec_id)
SELECT point, other, round(d, 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY point ORDER BY d, other) AS k FROM d) WHERE k = 1""")
def nearest_bucket(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double")).alias("xyz"))
    return J.nearest(e, e, "vec_id", 0.5 / 32, apart=True).withColumn("distance", F.round("distance", 6))


# windows, orders, samples --------------------------------------------------------------------------


@query("SELECT event_id, round(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 6) AS value_diff FROM events WHERE event_type <> 'error'")
def stage_diff(spark, sf):
    out = W.differences(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], ["value"], F.col("event_type") != "error")
    return out.select("event_id", F.round("value_diff", 6).alias("value_diff"))


_STATE = "CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'click' THEN 'running' ELSE 'succeeded' END"
_COND = "CASE WHEN event_id % 7 = 0 THEN 'prev_failed' WHEN event_id % 3 = 0 THEN 'prev_succeeded' WHEN event_id % 5 = 0 THEN 'prev_redundant' END"


@query(f"""WITH RECURSIVE t AS (
  SELECT event_id, user_id, {_STATE} AS state, coalesce({_COND}, 'prev_succeeded') AS cond, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
r AS (
  SELECT user_id, 0::BIGINT AS k, 'succeeded' AS prev, true AS going, NULL::BIGINT AS event_id, false AS may_run FROM (SELECT DISTINCT user_id FROM t)
  UNION ALL
  SELECT t.user_id, t.k,
         CASE WHEN cond = 'prev_failed' AND prev <> 'failed' THEN prev ELSE state END,
         going AND NOT (cond = 'prev_succeeded' AND prev <> 'succeeded'),
         t.event_id,
         going AND (cond <> 'prev_succeeded' OR prev = 'succeeded') AND (cond <> 'prev_failed' OR prev = 'failed')
  FROM r JOIN t ON t.user_id = r.user_id AND t.k = r.k + 1),
n AS (SELECT event_id, coalesce(lead(cond) OVER (PARTITION BY user_id ORDER BY k) <> 'prev_failed', true) AS fatal FROM t)
SELECT event_id, may_run, fatal FROM r JOIN n USING (event_id)""")
def sequential_gate(spark, sf):
    place = F.struct("ts", "event_id").alias("place")
    tasks = table(spark, sf, "events").select("event_id", "user_id", place, F.expr(_STATE).alias("state"), F.expr(_COND).alias("cond"))
    return W.sequential_gate(tasks, "user_id", "place", "state", "cond").select("event_id", "may_run", "fatal")


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 6 < 3 THEN 'a' WHEN n_nationkey % 6 < 5 THEN 'b' ELSE 'c' END AS pick FROM nation")
def roundrobin_pick(spark, sf):
    return W.roundrobin(table(spark, sf, "nation").select("n_nationkey"), "n_nationkey", [("a", 3), ("b", 2), ("c", 1)])


_WORDS = "md5('7/' || c_custkey)"
_HASH = " + ".join(f"('0x' || substr({_WORDS}, {k}, 8))::BIGINT" for k in (1, 9, 17, 25))


@query(f"SELECT c_custkey, CASE WHEN u * 10 < 1 THEN 'x' WHEN u * 10 < 4 THEN 'y' ELSE 'z' END AS pick FROM (SELECT c_custkey, (({_HASH}) % 4294967295) / 4294967295.0::DOUBLE AS u FROM customer)")
def weighted_choice_hashed(spark, sf):
    from tagweave.functions.sampling import draw

    return table(spark, sf, "customer").select("c_custkey", draw(("weighted_choice", (1, "x"), (3, "y"), (6, "z")), 7, F.col("c_custkey")).alias("pick"))


def _hashed(key: str) -> str:
    """The number in [0, 1) that seed 7 and the key give."""
    return "((" + " + ".join(f"('0x' || substr(md5('7/' || {key}), {k}, 8))::BIGINT" for k in (1, 9, 17, 25)) + ") % 4294967295) / 4294967295.0::DOUBLE"


@query(f"""WITH u AS (SELECT c_custkey, {_hashed("c_custkey")} AS u, {_hashed("'0/' || c_custkey")} AS v, {_hashed("'1/' || c_custkey")} AS w FROM customer)
SELECT c_custkey, round(pow(10, u * 3 - 1), 6) AS power, round(degrees(asin(u * (sin(radians(60)) - sin(radians(10))) + sin(radians(10)))), 6) AS elevation, CASE WHEN u * 8 < 2 THEN 'a' WHEN u * 8 < 3 THEN 'b' ELSE 'c' END AS pick,
  round(CASE WHEN u * 4 < 1 THEN v * 2 + 5 WHEN u * 4 < 3 THEN pow(10, w * 2) ELSE -1 END, 6) AS nested, (CASE WHEN u < 0.5 THEN 0 ELSE 1 END)::INT AS place FROM u""")
def random_draws(spark, sf):
    from tagweave.functions.sampling import draw

    specs = {"power": ("power_uniform", -1, 2), "elevation": ("spherical_sample", 10, 60), "pick": ("choice", ["a", "b", "c"], [2, 1, 5]), "nested": ("weighted_choice", (1, ("uniform", 5, 7)), (2, ("power_uniform", 0, 2)), (1, -1.0)), "place": ("cat", 0.5, 0.5)}
    out = table(spark, sf, "customer").select("c_custkey", *[draw(spec, 7, F.col("c_custkey")).alias(k) for k, spec in specs.items()])
    return out.withColumns({c: F.round(c, 6) for c in ("power", "elevation", "nested")})


@query(f"""WITH p AS (SELECT p_partkey AS k, p_size::DOUBLE AS low, p_size + p_retailprice AS high FROM part), e AS (SELECT *, unnest(range(0, 5)) AS i FROM p)
SELECT k AS p_partkey, i::INT AS i, round(low + i / 4.0::DOUBLE * (high - low), 6) AS even, round(i * 20.0::DOUBLE + (0.1 + {_hashed("k || '/' || i")} * 0.8) * 20, 6) AS spaced,
  round((CASE WHEN i = 0 THEN least(low / -2, high / -2) ELSE greatest(low / -2, high / -2) END), 6) AS domain, round(-(high - low) / 10 * 2 + low, 6) AS shifted FROM e""")
def number_series(spark, sf):
    from tagweave.functions.sampling import uniform

    low, high = F.col("p_size").cast("double"), F.col("p_size") + F.col("p_retailprice")
    series = F.arrays_zip(S.linvec(5, low, high).alias("even"), S.randomspacing(0.0, 100.0, 5, 0.1, lambda k: uniform(7, F.col("p_partkey"), F.lit("/"), k)).alias("spaced"))
    domain, affine = S.new_domain((low, high), F.lit(-2.0), F.lit(0.0)), S.affine_to((low, high), (F.lit(2.0), F.lit(12.0)))
    rows = table(spark, sf, "part").select("p_partkey", F.posexplode(series).alias("i", "s"), domain.alias("d"), affine["b"].alias("shifted"))
    ends = F.when(F.col("i") == 0, F.get("d", F.lit(0))).otherwise(F.get("d", F.lit(1)))
    return rows.select("p_partkey", "i", F.round("s.even", 6).alias("even"), F.round("s.spaced", 6).alias("spaced"), F.round(ends, 6).alias("domain"), F.round("shifted", 6).alias("shifted"))


@query("""WITH s AS (SELECT user_id, value, lead(value) OVER w AS nv, row_number() OVER w - 1 AS k FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, p AS place, round(CASE WHEN nv IS NULL THEN value ELSE value + (nv - value) * least(p - k, 1) END, 6)::DOUBLE AS value FROM s, (VALUES (0.5::DOUBLE), (2.25), (400.0)) a(p)
WHERE k = floor(p) OR (nv IS NULL AND floor(p) > k)""")
def lerp_resample(spark, sf):
    at = spark.createDataFrame([(0.5,), (2.25,), (400.0,)], "place double")
    return W.lerp_sampled(table(spark, sf, "events"), ["user_id"], "ts", "value", at, "place").withColumn("value", F.round("value", 6))


@query("SELECT o_orderkey, o_orderpriority, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::INT AS code FROM orders")
def dense_dictionary_encode(spark, sf):
    return A.dictionary_encoded(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority")


@query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def topk_views(spark, sf):
    return W.top(table(spark, sf, "part").select("p_partkey", "p_retailprice"), [F.desc("p_retailprice"), "p_partkey"], 25)


@query("SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('0/' || doc_id), doc_id) AS k FROM documents) WHERE k <= 10")
def examples_per_reason(spark, sf):
    return W.hashed_examples(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], "doc_id", 10)


@query("SELECT doc_id, CASE WHEN k <= 160 THEN 'train' WHEN k <= 180 THEN 'val' WHEN k <= 200 THEN 'test' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('0/' || doc_id), doc_id) AS k FROM documents)")
def hash_split(spark, sf):
    return W.split(table(spark, sf, "documents").select("doc_id"), "doc_id", [("train", 160), ("val", 20), ("test", 20)])


@query("SELECT c_custkey, (" + _HASH + ") % 4294967295 AS seed FROM customer")
def int_hash_seed(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", S.int_hash(F.lit("7/"), F.col("c_custkey")).alias("seed"))


@query("SELECT user_id, event_id, floor((row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1) / 20)::INT AS page FROM events")
def paging(spark, sf):
    return W.paged(table(spark, sf, "events").select("user_id", "event_id", "ts"), ["user_id"], ["ts"], 20).drop("ts")


@query("SELECT n_nationkey, n_name, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name)::INT AS number FROM nation")
def file_renumbering(spark, sf):
    return W.renumbered(table(spark, sf, "nation"), ["n_regionkey"], "n_name").select("n_nationkey", "n_name", "number")


@query("""SELECT o_orderstatus, o_orderkey, o_totalprice FROM orders WHERE o_totalprice < (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)""")
def outlier_trim(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    edge = A.quantiles(orders, [], F.col("o_totalprice"), 9).select(F.col("p99").alias("edge"))  # one row
    return orders.crossJoin(F.broadcast(edge)).where("o_totalprice < edge").drop("edge")


# text, vectors, time -------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN contains(text, 'password') THEN 'password' WHEN contains(text, 'License') THEN 'license' WHEN regexp_matches(text, '[0-9]{3}') THEN 'number' ELSE 'unknown' END AS reason FROM documents""")
def crash_reason_rules(spark, sf):
    from tagweave.sources.logs import first_reason

    rules = [("password", F.col("text").contains("password")), ("license", F.col("text").contains("License")), ("number", F.col("text").rlike("[0-9]{3}"))]
    return table(spark, sf, "documents").select("doc_id", first_reason(rules, "unknown").alias("reason"))


@query("""WITH n AS (SELECT page_id, CASE WHEN page_id % 4 = 0 AND page_id % 5 <> 0 THEN 'Image_' WHEN page_id % 4 = 1 THEN '_' ELSE '' END || page_id % 3 || '_0_' || lpad((page_id % 97)::VARCHAR, 4, '0')
    || CASE WHEN page_id % 5 = 0 THEN '' ELSE '_' || page_id % 2 END || CASE page_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '_.tar.gz' ELSE '' END AS name FROM pages),
p AS (SELECT page_id, string_split(trim(split_part(name, '.', 1), '_'), '_') AS w FROM n),
q AS (SELECT page_id, CASE WHEN len(w) = 5 THEN w[2:] WHEN len(w) = 4 THEN w END AS w FROM p)
SELECT page_id, w[1]::INT AS cam_rig, w[2]::INT AS resample, w[3]::INT AS frame, w[4]::INT AS subcam FROM q""")
def suffix_parse(spark, sf):
    from tagweave.sources.frames import parsed_suffix

    n = F.col("page_id")
    before = F.when((n % 4 == 0) & (n % 5 != 0), F.lit("Image_")).when(n % 4 == 1, F.lit("_")).otherwise(F.lit(""))
    last = F.when(n % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("_"), (n % 2).cast("string")))
    end = F.when(n % 3 == 0, ".png").when(n % 3 == 1, "_.tar.gz").otherwise("")
    name = F.concat(before, (n % 3).cast("string"), F.lit("_0_"), F.lpad((n % 97).cast("string"), 4, "0"), last, end)
    return table(spark, sf, "pages").select("page_id", parsed_suffix(name).alias("s")).select("page_id", "s.cam_rig", "s.resample", "s.frame", "s.subcam")


@query("""SELECT vec_id, round(sqrt(list_dot_product(e, e)), 4) AS norm, round(list_dot_product(e, list_reverse(e)), 4) AS folded FROM (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings)""")
def embedding_norm_dot(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    return e.select("vec_id", F.round(V.norm(F.col("e")), 4).alias("norm"), F.round(V.dot(F.col("e"), F.reverse("e")), 4).alias("folded"))


@query("""SELECT p_partkey, lower(x[1] || array_to_string(list_transform(range(2, len(x) + 1), lambda i:
    CASE WHEN x[i] BETWEEN 'A' AND 'Z' AND x[i + 1] BETWEEN 'a' AND 'z' THEN '_' ELSE '' END || x[i]), '')) AS snake
  FROM (SELECT p_partkey, string_split('KitchenNEW' || replace(p_brand, '#', 'No') || 'PartNAMEs', '') AS x FROM part)""")
def snake_case_names(spark, sf):
    name = F.concat(F.lit("rooms/Old/KitchenNEW"), F.replace("p_brand", F.lit("#"), F.lit("No")), F.lit("PartNAMEs"))
    return table(spark, sf, "part").select("p_partkey", S.snake_case(name).alias("snake"))


@query("SELECT event_type, date_trunc('hour', ts) AS start, count(*)::BIGINT AS n, round(sum(value), 4)::DOUBLE AS total FROM events GROUP BY 1, 2")
def hourly_tumbling(spark, sf):
    w = table(spark, sf, "events").groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select("event_type", F.col("w.start").alias("start"), "n", "total")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 8 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, count(*)::BIGINT AS n FROM s GROUP BY user_id, k""")
def session_8h(spark, sf):
    s = table(spark, sf, "events").groupBy("user_id", F.session_window("ts", "8 hours").alias("w")).agg(F.count("*").alias("n"))
    return s.select("user_id", F.col("w.start").alias("start"), "n")
