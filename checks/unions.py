"""Unions of drifting inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.analogs import ADVANCED_KEYS, RESULTS, SUMMARY_KEYS, TEAM_KEYS_SEEN
from checks.registry import check, load, run
from matchloom.operators import unions as ops


@check(
    "U1_relaxed_union",
    """SELECT CAST(n_nationkey AS double) AS key, n_name AS name, CAST(n_regionkey AS string) AS tag, NULL AS balance
    FROM nation UNION ALL SELECT CAST(r_regionkey AS double), r_name, NULL, NULL FROM region
    UNION ALL SELECT c_acctbal, c_name, c_mktsegment, c_acctbal FROM customer""",
)
def relaxed_union(spark, d):
    nation = load(spark, d, "nation").select(
        F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("tag")
    )
    region = load(spark, d, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("key"))
    customer = load(spark, d, "customer").select(
        F.col("c_mktsegment").alias("tag"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_acctbal").alias("key"),
        F.col("c_name").alias("name"),
    )
    return ops.relaxed_union([nation, None, region, customer])


@check(
    "U2_union_distinct",
    """SELECT l_partkey AS player FROM lineitem WHERE l_linestatus = 'O'
    UNION SELECT l_partkey FROM lineitem WHERE l_linestatus = 'F'""",
)
def union_distinct(spark, d):
    items = load(spark, d, "lineitem")
    home, away = (
        items.filter(F.col("l_linestatus") == s).select(F.col("l_partkey").alias("player")) for s in "OF"
    )
    return ops.union_distinct(home, away)


@check(
    "U3_union_keys",
    "SELECT MatchURL FROM a UNION ALL SELECT MatchURL FROM b UNION ALL SELECT MatchURL FROM c",
    results=RESULTS,
    a=SUMMARY_KEYS,
    b=TEAM_KEYS_SEEN,
    c=ADVANCED_KEYS,
)
def union_keys(spark, d):
    results = run(spark, d, RESULTS)
    frames = [
        run(spark, d, sql.replace("DISTINCT", ""), results=results)
        for sql in (SUMMARY_KEYS, TEAM_KEYS_SEEN, ADVANCED_KEYS)
    ]
    return ops.union_keys(frames, ["MatchURL"])


@check(
    "U4_bundle_union",
    """SELECT 'summary' AS member, l_orderkey, l_partkey, CAST(l_linenumber AS double) AS value FROM lineitem
    WHERE l_returnflag = 'A' UNION ALL SELECT 'summary', l_orderkey, l_partkey, l_tax FROM lineitem
    WHERE l_returnflag = 'N' UNION ALL SELECT 'team', l_orderkey, l_partkey, l_tax FROM lineitem
    WHERE l_returnflag = 'R'""",
)
def bundle_union(spark, d):
    def rows(flag, value):
        items = load(spark, d, "lineitem").filter(F.col("l_returnflag") == flag)
        return items.select("l_orderkey", "l_partkey", F.col(value).alias("value"))

    bundle = ops.union_bundles(
        [
            ops.MatchBundle(summary=rows("A", "l_linenumber")),
            None,
            ops.MatchBundle(summary=rows("N", "l_tax"), team={"summary": rows("R", "l_tax")}),
        ]
    )
    summary = bundle.summary.select(F.lit("summary").alias("member"), "*")
    return summary.unionAll(bundle.team["summary"].select(F.lit("team"), "*"))
