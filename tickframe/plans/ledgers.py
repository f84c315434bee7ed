"""Integrity ledgers over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickframe.operators import ledger as L
from tickframe.plans.registry import query
from tickframe.sources.adapters import Tables

_FOLD = """cur AS (SELECT partition, check_name, arg_max(verdict, seq) AS verdict, max(seq) AS seq FROM ledger GROUP BY 1, 2),
           fold AS (SELECT partition, bool_or(verdict <> 'clean') AS withheld, count(*) AS checks, coalesce(min(seq) FILTER (WHERE verdict <> 'clean'), max(seq)) AS deciding_seq FROM cur GROUP BY 1)"""


@query("quarantine_fold", f"WITH {_FOLD} SELECT f.*, c.check_name AS deciding_check FROM fold f JOIN cur c ON c.partition = f.partition AND c.seq = f.deciding_seq")
def quarantine_fold(t: Tables):
    return L.quarantine_fold(t.ledger())


@query("quarantine_exclusion", f"WITH {_FOLD} SELECT s.ticker, count(*) AS n FROM slots s WHERE NOT EXISTS (SELECT 1 FROM fold f WHERE f.withheld AND f.partition = s.ticker || '/' || CAST(s.day AS VARCHAR)) GROUP BY 1")
def quarantine_exclusion(t: Tables):
    rows = t.slots().withColumn("partition", F.concat_ws("/", "ticker", F.col("day").cast("string")))
    return L.clear_of_quarantine(rows, L.quarantine_fold(t.ledger())).groupBy("ticker").agg(F.count(F.lit(1)).alias("n"))


@query("quarantined_count", f"WITH {_FOLD} SELECT count(*) AS withheld FROM fold WHERE withheld")
def quarantined_count(t: Tables):
    return L.quarantine_fold(t.ledger()).where("withheld").agg(F.count(F.lit(1)).alias("withheld"))


_NEXT = "SELECT event_type || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS partition, 'c' || (user_id % 3) AS check_name, CASE WHEN min(value) > 1 THEN 'clean' ELSE 'quarantined' END AS verdict FROM events GROUP BY 1, 2"


@query(
    "verdict_transitions",
    f"""WITH cur AS (SELECT partition, check_name, arg_max(verdict, seq) AS verdict, CASE WHEN arg_max(seq, seq) % 4 = 0 THEN 'person' ELSE 'battery' END AS provenance FROM ledger GROUP BY 1, 2), n AS ({_NEXT})
        SELECT n.partition, n.check_name, n.verdict, c.verdict AS was FROM n LEFT JOIN cur c USING (partition, check_name) WHERE CASE WHEN c.verdict IS NULL THEN n.verdict <> 'clean' ELSE n.verdict <> c.verdict AND c.provenance <> 'person' END""",
)
def verdict_transitions(t: Tables):
    cur = L.latest(t.ledger().withColumn("provenance", F.when(F.col("seq") % 4 == 0, "person").otherwise("battery")).withColumn("s", F.col("seq")), ["partition", "check_name"], "seq")
    found = t.table("events").groupBy(F.concat_ws("/", "event_type", F.to_date("ts").cast("string")).alias("partition"), F.concat(F.lit("c"), F.col("user_id") % 3).alias("check_name")).agg(F.when(F.min("value") > 1, "clean").otherwise("quarantined").alias("verdict"))
    return L.transitions(cur, found, ["partition", "check_name"])


@query(
    "sign_off",
    f"""WITH {_FOLD}, d AS (SELECT DISTINCT partition, check_name FROM ledger WHERE seq % 11 = 0)
        SELECT CASE WHEN c.verdict <> 'clean' THEN 'made' ELSE 'unmatched' END AS outcome, count(*) AS n FROM d JOIN cur c USING (partition, check_name) GROUP BY 1""",
)
def sign_off(t: Tables):
    keys = ["partition", "check_name"]
    made, left = L.sign_off(L.latest(t.ledger(), keys), t.ledger().where("seq % 11 = 0").select(*keys).distinct(), keys)
    both = made.select(*keys, F.lit("made").alias("outcome")).unionByName(left.select(*keys, F.lit("unmatched").alias("outcome")))
    return both.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


_SCRUB = """SELECT coalesce(m.partition, i.partition) AS partition, m.sha256 AS recorded, i.sha256 AS found, CASE WHEN i.sha256 IS NULL THEN 'missing' WHEN m.sha256 IS NULL THEN 'orphan' ELSE 'differs' END AS state
            FROM (SELECT * FROM manifest WHERE partition % 23 <> 0) m FULL JOIN inventory i ON i.partition = m.partition WHERE m.sha256 IS DISTINCT FROM i.sha256"""


@query("scrub", _SCRUB)
def scrub(t: Tables):
    return L.scrub(t.manifest().where("partition % 23 <> 0"), t.inventory())


@query("backup_scrub", f"SELECT * FROM ({_SCRUB}) WHERE state <> 'missing' OR partition % 2 = 0")
def backup_scrub(t: Tables):
    m = t.manifest().withColumn("seq", F.col("partition"))
    trimmed = m.where("partition % 2 = 1").withColumn("kind", F.lit("trim"))
    return L.scrub(t.manifest().where("partition % 23 <> 0"), t.inventory(), L.designed_absences(m, trimmed))


@query("designed_absences", "SELECT partition FROM manifest WHERE partition % 4 = 1")
def designed_absences(t: Tables):
    m = t.manifest().withColumn("seq", F.col("partition"))
    lines = m.where("partition % 2 = 1").withColumn("kind", F.when(F.col("partition") % 4 == 1, "trim").otherwise("restore"))
    return L.designed_absences(m, lines)


@query(
    "guarded_append",
    """WITH b AS (SELECT partition, CASE WHEN partition % 7 = 0 THEN n - 1 ELSE n + partition % 2 END AS n FROM manifest), j AS (SELECT b.partition, b.n < m.n AS refused FROM b LEFT JOIN (SELECT * FROM manifest WHERE partition % 3 <> 0) m USING (partition))
       SELECT coalesce(refused, false) AS refused, count(*) AS c FROM j GROUP BY 1""",
)
def guarded_append(t: Tables):
    m = t.manifest().select("partition", "n")
    batch = m.withColumn("n", F.when(F.col("partition") % 7 == 0, F.col("n") - 1).otherwise(F.col("n") + F.col("partition") % 2))
    ok, refused = L.guarded_append(m.where("partition % 3 <> 0"), batch)
    both = ok.select(F.lit(False).alias("refused")).unionByName(refused.select(F.lit(True).alias("refused")))
    return both.groupBy("refused").agg(F.count(F.lit(1)).alias("c"))


@query(
    "ledger_divergence",
    """WITH l AS (SELECT partition % 97 AS p, sha256, partition AS seq FROM manifest), r AS (SELECT partition % 97 AS p, CASE WHEN partition > 300 AND partition % 5 = 0 THEN 'x' ELSE sha256 END AS sha256, partition AS seq FROM manifest WHERE partition < (SELECT max(partition) FROM manifest) - 20),
       f AS (SELECT min(coalesce(l.seq, r.seq)) AS e FROM l FULL JOIN r ON l.seq = r.seq WHERE l.sha256 IS DISTINCT FROM r.sha256),
       tail AS (SELECT p, arg_max(sha256, seq) AS sha256 FROM l WHERE seq >= (SELECT e FROM f) GROUP BY 1)
       SELECT (SELECT e FROM f) AS prefix_end, (SELECT count(*) FROM l WHERE seq >= (SELECT e FROM f)) AS left_past, (SELECT count(*) FROM r WHERE seq >= (SELECT e FROM f)) AS right_past,
       (SELECT count(*) FROM tail t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.p = t.p AND r.sha256 = t.sha256)) AS foreign_partitions""",
)
def ledger_divergence(t: Tables):
    m = t.manifest().select((F.col("partition") % 97).alias("partition"), "sha256", F.col("partition").alias("seq"))
    last = m.agg((F.max("seq") - 20).alias("_m"))
    other = m.join(F.broadcast(last)).where("seq < _m").drop("_m").withColumn("sha256", F.when((F.col("seq") > 300) & (F.col("seq") % 5 == 0), "x").otherwise(F.col("sha256")))
    return L.divergence(m, other)


@query(
    "upload_owed",
    """WITH m AS (SELECT o_orderkey AS seq, o_custkey AS partition, o_custkey % 50 AS parent, CASE WHEN o_custkey < 50 THEN 'partition' ELSE 'segment' END AS kind FROM orders)
       SELECT seq, kind FROM m WHERE seq >= 5000 AND (kind = 'partition' OR NOT EXISTS (SELECT 1 FROM m p WHERE p.kind = 'partition' AND p.partition = m.parent))""",
)
def upload_owed(t: Tables):
    m = t.table("orders").select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").alias("partition"), (F.col("o_custkey") % 50).alias("parent"), F.when(F.col("o_custkey") < 50, "partition").otherwise("segment").alias("kind"))
    return L.upload_owed(m, 5000).select("seq", "kind")
