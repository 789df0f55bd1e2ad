"""Merkle fixity audit of WARC record stores.

Records lie in the order of their id. A leaf covers the records of one id, an
inner node ``FANOUT`` consecutive children and with them an ordered range of
byte offsets; its hash covers its children's places, hashes and lengths.
Replicas are compared from the root: only children of nodes that differ are
looked at, so an intact branch costs one comparison.

All of it is DataFrame work. The payloads are read and hashed once per store,
only (id, length, digest) is shuffled, and the tree is written to the
checkpoint folder so that the descent does not hash again. Groups have at most
FANOUT rows; records that share an id are combined by partial sums, so an id
may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHIFT = 6
FANOUT = 1 << SHIFT


def warc_record(uri: str, payload: str) -> Column:
    """The bytes of a WARC response record: headers, empty line, payload, two
    line ends. Null fields count as empty."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(F.col(uri).cast("string"), F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def leaves(records: DataFrame) -> DataFrame:
    """node, records, length and hash of every id of ``records`` (id bigint,
    record binary). A null id is a leaf of its own before all others. Equal
    rows count each; the hash of an id with several records does not depend on
    their order."""
    digest = F.sha2(F.coalesce("record", F.lit(b"")), 256)
    rows = records.select(F.col("id").cast("bigint").alias("node"), F.coalesce(F.octet_length("record"), F.lit(0)).cast("bigint").alias("length"), digest.alias("digest"))
    part = lambda at: F.sum(F.conv(F.substring("digest", at, 15), 16, 10).cast("decimal(38,0)"))
    grouped = rows.groupBy("node").agg(F.count("*").alias("records"), F.sum("length").cast("bigint").alias("length"), F.min("digest").alias("_one"),
                                       F.concat_ws("|", F.count("*"), *(part(at) for at in (1, 16, 31, 46))).alias("_many"))
    return grouped.select("node", "records", "length", F.when(F.col("records") == 1, F.col("_one")).otherwise(F.sha2("_many", 256)).alias("hash"))


def tree(records: DataFrame) -> DataFrame:
    """level (0: leaves), node, records, length and hash of all nodes, written
    to the checkpoint folder. An empty store has no nodes."""
    base = leaves(records).checkpoint()
    lo, hi = base.agg(F.min("node"), F.max("node")).first()
    levels = [base.withColumn("level", F.lit(0))]
    depth = 0 if lo is None else 1
    while lo is not None and (lo >> SHIFT * (depth - 1) < -1 or hi >> SHIFT * (depth - 1) > 0):
        depth += 1  # ends with one top node, or two with negative ids
    for level in range(1, depth + 1):
        below = levels[-1]
        child = F.struct(F.col("node"), F.col("hash"), F.col("length"))
        up = below.withColumn("parent", F.shiftright("node", SHIFT)).groupBy("parent").agg(
            F.sum("records").alias("records"), F.sum("length").cast("bigint").alias("length"),
            F.sha2(F.to_json(F.sort_array(F.collect_list(child))), 256).alias("hash"))
        levels.append(up.select(F.col("parent").alias("node"), "records", "length", "hash", F.lit(level).alias("level")))
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out.select("level", "node", "records", "length", "hash").checkpoint()


def root(nodes: DataFrame) -> str | None:
    """The hash of the whole store; None if it is empty."""
    depth = nodes.agg(F.max("level")).first()[0]
    if depth is None:
        return None
    top = nodes.where(F.col("level") == depth).orderBy(F.asc_nulls_first("node")).collect()  # null, negative and other ids
    return "".join(r.hash for r in top)


def offsets(nodes: DataFrame) -> DataFrame:
    """The leaves of a tree with the byte offset of their first record: from
    the top down, a node's offset is its parent's plus its elder siblings'
    lengths (at most FANOUT rows in a window)."""
    depth = nodes.agg(F.max("level")).first()[0]
    if depth is None:
        return nodes.where("level = 0").withColumn("offset", F.lit(0).cast("bigint"))
    before = F.coalesce(F.sum("length").over(Window.partitionBy("parent").orderBy(F.asc_nulls_first("node")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = None
    for level in range(depth, -1, -1):
        here = nodes.where(F.col("level") == level).withColumn("parent", F.shiftright("node", SHIFT) if level < depth else F.lit(0).cast("bigint"))
        here = here.withColumn("_before", F.when(F.col("parent").isNull(), F.lit(0)).otherwise(before).cast("bigint"))
        if at is None:  # the null id's branch comes first
            first = F.sum(F.when(F.col("node").isNull(), F.col("length")).otherwise(0)).over(Window.partitionBy("parent"))
            at = here.withColumn("offset", F.when(F.col("node").isNull(), F.lit(0)).otherwise(F.greatest(first, F.col("_before")))).select("node", F.col("offset").cast("bigint"))
            continue
        above = at.select(F.col("node").alias("_p"), F.col("offset").alias("_o"))
        at = here.join(above, F.col("parent").eqNullSafe(F.col("_p"))).select("node", (F.col("_o") + F.col("_before")).alias("offset"), *(["records", "length", "hash"] if level == 0 else []))
    return at


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """The leaves at which two stores (id bigint, record binary) differ:
    id, status (corrupt, missing, extra: in the replica only), offset and
    length in the primary store, expected and found hash. Equal roots end the
    audit at once; otherwise every level keeps only the children of nodes that
    differ."""
    a, b = tree(primary), tree(replica)
    depth = max([r[0] for r in (a.agg(F.max("level")).first(), b.agg(F.max("level")).first()) if r[0] is not None], default=0)
    differ = None
    for level in range(depth, -1, -1):
        x, y = (t.where(F.col("level") == level).select("node", F.col("hash").alias(name), *(["length"] if name == "expected" else [])) for t, name in ((a, "expected"), (b, "found")))
        if differ is not None:
            parents = differ.select(F.col("node").alias("_p"))
            x, y = (t.join(parents, F.shiftright("node", SHIFT).eqNullSafe(F.col("_p")), "left_semi") for t in (x, y))
        y = y.withColumnRenamed("node", "_node")
        met = x.join(y, F.col("node").eqNullSafe(F.col("_node")), "full_outer")
        met = met.where(~F.col("expected").eqNullSafe(F.col("found")))
        differ = met.select(F.coalesce("node", "_node").alias("node"), "expected", "found")
    places = offsets(a).select(F.col("node").alias("_n"), "offset", "length")
    out = differ.join(places, F.col("node").eqNullSafe(F.col("_n")), "left")
    status = F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra").otherwise("corrupt")
    return out.select(F.col("node").alias("id"), status.alias("status"), "offset", "length", "expected", "found")
