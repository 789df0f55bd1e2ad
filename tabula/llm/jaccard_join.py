"""Exact n-gram Jaccard join with set relations.

Documents are sets of word shingles. Two sets link when
``intersection * den >= union * num``. The join returns the connected
components of the links, without listing the pairs of a group:

1. Index. Shingles are ordered by how many documents hold them (counted over
   all documents by a lookup between blocks and buckets), rarest first. Two linked
   sets share a shingle among the first ``n - ceil(t * n) + 1`` of either.
   Sets whose first ones are all unique to them can have no partner and stop
   here; the others form the inverted lists.
2. Equal sets are one set from here on.
3. Leaders. In each list the entry with the fewest rarer shingles before it is
   compared with all others: one comparison per entry, not per pair. The sizes
   of these intersections are kept. Links give provisional components.
4. Skipping in the index. A list is cut into blocks, entries are grouped by
   size and position, and two groups are skipped as a whole when the shingles
   left after their positions are too few; entries of one component are
   skipped, too, since their answer is known.
5. Skipping by answers. For the remaining pairs (y, z), a set x that is highly
   similar to y and was compared with z bounds the intersection:
   |x & z| - |x - y| <= |y & z| <= |x & z| + |y - x|. Most pairs are decided by
   that; only the others read both sets.

No step is limited: every pair of different sets that can link is decided.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.llm import blocks as B
from tabula.llm import ragged
from tabula.llm.components import components

LIST_BLOCK = 1024
_NEXT = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, sorted and distinct in each document; their offsets).
    A document with fewer than k words has one shingle, all its words."""
    words, doc = ragged.words(data, offsets, ragged.NOT_SPACE)
    at = np.searchsorted(doc, np.arange(len(offsets)))
    chain = words
    for j in range(1, k):
        chain = ragged.mix(chain[:-1] * _NEXT + words[j:]) if len(chain) > 1 else chain[:0]
    sets = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            sets.append(np.unique(chain[a:b - k + 1]))
        else:
            h = words[a:b][:1]
            for j in range(a + 1, b):
                h = ragged.mix(h * _NEXT + words[j])
            sets.append(h ^ np.uint64(b - a))  # a short sequence equals no longer one
    size = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(size)]).astype(np.int64)


class _Block:
    def __init__(self, table: pa.Table, k: int):
        self.tokens, self.at = shingle_sets(*ragged.text_bytes(table.column("text")), k)
        self.size = np.diff(self.at)
        self.doc = np.repeat(np.arange(len(self.size)), self.size)
        sums = np.zeros(len(self.size), np.uint64)
        full = self.size > 0
        if full.any():
            sums[full] = np.add.reduceat(ragged.mix(self.tokens.copy()), self.at[:-1][full])
        self.set_id = ragged.mix(sums + self.size.astype(np.uint64) * _NEXT).view(np.int64)
        self.keys, self.key_of = np.unique(self.tokens, return_inverse=True)


BLOCK_BYTES = 1 << 23
SETS = "doc_id bigint, row_key bigint, n_shingles bigint, set_id bigint, skip bigint, tokens binary"


def _sets(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Every document with its set; tokens (rarest first) only for sets with
    entries in the index, which begin after `skip` tokens."""
    buckets = B.count_for(docs, BLOCK_BYTES)  # and as many blocks
    rows = B.blocked(docs, ["doc_id", "row_key"], count=buckets)

    def send(table: pa.Table) -> pa.Table:
        block = _Block(table, k)
        counts = np.minimum(np.bincount(block.key_of, minlength=len(block.keys)), 255).astype(np.uint8)  # orders the lists; 1 stays 1
        return B.send(B.block_of(table), block.keys, buckets, True, lambda cuts: B.binary(counts, cuts))

    def answer(table: pa.Table) -> pa.Array:
        keys, sizes = B.numbers(table.column("keys"), "<u4")
        held, _ = B.numbers(table.column("extra"), "u1")
        _, number = np.unique(keys, return_inverse=True)
        total = np.bincount(number, weights=held)
        rank = np.where(total < 2, 0, np.ceil(np.log2(np.maximum(total, 2))).astype(np.int64)).astype(np.uint8)
        return B.binary(rank[number], np.concatenate([[0], np.cumsum(sizes)]))

    def index(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(),) * 5 + (pa.binary(),)], names=["doc_id", "row_key", "n_shingles", "set_id", "skip", "tokens"])
        block = _Block(left, k)
        rank = B.answers(right, "u1")[block.key_of]
        n = block.size
        prefix = n - (-(-n * num // den)) + 1
        unique = np.bincount(block.doc, weights=rank == 0, minlength=len(n)).astype(np.int64)
        listed = (n > 0) & (unique < prefix)
        mine = listed[block.doc]
        doc, tokens = block.doc[mine], block.tokens[mine]
        order = np.lexsort((tokens, rank[mine], doc))
        size = np.where(listed, n, 0)
        values = B.binary(tokens[order], np.concatenate([[0], np.cumsum(size)]))
        return pa.table([left.column("doc_id").cast(pa.int64()), left.column("row_key"), pa.array(n), pa.array(block.set_id), pa.array(np.where(listed, unique, -1)), values],
                        names=["doc_id", "row_key", "n_shingles", "set_id", "skip", "tokens"])

    ranks = B.lookup(rows, B.lean(send), B.lean(answer))
    return rows.groupBy("block").cogroup(ranks.groupBy("block")).applyInArrow(B.lean(index), SETS)


def _postings(sets: DataFrame, num: int, den: int) -> DataFrame:
    """The inverted lists: token, set_id, n, place (of the token in the set)."""
    def run(batches):
        for b in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for set_id, n, skip, tokens in zip(*(b.column(c).to_pylist() for c in ("set_id", "n", "skip", "tokens")), strict=True):
                place = np.arange(skip, n - (-(-n * num // den)) + 1)
                out[0].append(np.frombuffer(tokens, np.int64)[place])
                out[1].append(np.full(len(place), set_id))
                out[2].append(np.full(len(place), n))
                out[3].append(place)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in out], names=["token", "set_id", "n", "place"])
    return sets.mapInArrow(run, "token bigint, set_id bigint, n bigint, place bigint")


def _possible(na, pa_, nb, pb, num: int, den: int):
    """Sizes and positions leave room for a link: the needed intersection is
    num / (num + den) of both sizes. Works on columns and on arrays."""
    need = (na + nb) * num
    return (na * den >= nb * num) & (nb * den >= na * num) & ((na - pa_) * (num + den) >= need) & ((nb - pb) * (num + den) >= need)


def _linked(shared: Column, num: int, den: int) -> Column:
    return shared * den >= (F.col("na") + F.col("nb") - shared) * num


def _compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b, na, nb) with ``shared``, the size of the intersection."""
    def run(batches):
        for r in batches:
            got = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                   for x, y in zip(r.column("ta").to_pylist(), r.column("tb").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(r.column(c) for c in ("a", "b", "na", "nb")), pa.array(got, pa.int64())], names=["a", "b", "na", "nb", "shared"])
    of = lambda x: sets.select(F.col("set_id").alias(x), F.col("tokens").alias(f"t{x}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "nb", "ta", "tb")
    return both.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, shared bigint")


def _with_leaders(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a: leader, b) of the lists."""
    first = postings.groupBy("token").agg(F.min(F.struct("place", "n", "set_id")).alias("f"), F.count("*").alias("m")).where("m > 1")
    first = first.select("token", F.col("f.set_id").alias("a"), F.col("f.n").alias("na"), F.col("f.place").alias("pa"))
    met = postings.join(first, "token").where(F.col("set_id") != F.col("a"))
    met = met.where(_possible(F.col("na"), F.col("pa"), F.col("n"), F.col("place"), num, den))
    return met.select("a", F.col("set_id").alias("b"), "na", F.col("n").alias("nb")).distinct()


def _across(postings: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a < b) of different components that share a list."""
    several = postings.groupBy("token").agg(F.count("*").alias("m"), F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    listed = postings.join(several.select("token", F.ceil(F.col("m") / LIST_BLOCK).cast("int").alias("blocks")), "token")
    mine = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = listed.withColumn("mine", mine).withColumn("other", other)
    dealt = dealt.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")})

    def meet(table: pa.Table) -> pa.Table:
        set_id, n, place, root, mine_, i, j = (table.column(c).to_numpy() for c in ("set_id", "n", "place", "root", "mine", "i", "j"))
        out: list[list[np.ndarray]] = [[], [], [], []]
        order = np.lexsort((place, n))
        set_id, n, place, root, mine_ = (x[order] for x in (set_id, n, place, root, mine_))
        new = np.ones(len(n), dtype=bool)
        new[1:] = (n[1:] != n[:-1]) | (place[1:] != place[:-1])
        at = np.append(np.flatnonzero(new), len(n))
        groups = [(int(n[a]), int(place[a]), a, b) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        for x, (nx, px, a, b) in enumerate(groups):
            for ny, py, c, d in groups[x:]:
                if nx * den < ny * num:
                    break  # sorted by size: all later groups are too large
                if not _possible(nx, px, ny, py, num, den):
                    continue  # skips the whole group by position
                p, q = np.repeat(np.arange(a, b), d - c), np.tile(np.arange(c, d), b - a)
                good = root[p] != root[q]
                if c == a:
                    good &= p < q
                if i[0] != j[0]:
                    good &= mine_[p] != mine_[q]  # pairs inside a block are met elsewhere
                p, q = p[good], q[good]
                low = set_id[p] < set_id[q]
                for x_, y_ in zip(out, (np.where(low, set_id[p], set_id[q]), np.where(low, set_id[q], set_id[p]), np.where(low, n[p], n[q]), np.where(low, n[q], n[p])), strict=True):
                    x_.append(y_)
        return pa.table([pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in out], names=["a", "b", "na", "nb"])

    return dealt.groupBy("token", "i", "j").applyInArrow(meet, "a bigint, b bigint, na bigint, nb bigint").distinct()


def _derived(pairs: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """``pairs`` with ``decided``: 1 linked, 0 not, null unknown, from the
    compared pairs ``known`` (a: leader, b, na, nb, shared)."""
    linked = known.where(_linked(F.col("shared"), num, den))
    near = linked.groupBy("b").agg(F.max(F.struct(F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared")), "a", "na", "shared")).alias("l"))
    near = near.select(F.col("b").alias("_y"), F.col("l.a").alias("_x"), F.col("l.na").alias("_nx"), F.col("l.shared").alias("_xy"))
    seen = known.select(F.col("a").alias("_kx"), F.col("b").alias("_kz"), F.col("shared").alias("_xz"))
    need = (F.col("na") + F.col("nb")) * num
    out = pairs
    for y, z, ny in (("a", "b", "na"), ("b", "a", "nb")):
        met = out.join(near, F.col(y) == F.col("_y"), "left").join(seen, (F.col("_x") == F.col("_kx")) & (F.col(z) == F.col("_kz")), "left")
        most, least = F.col("_xz") + F.col(ny) - F.col("_xy"), F.col("_xz") - (F.col("_nx") - F.col("_xy"))
        decided = F.when(most * (num + den) < need, 0).when(least * (num + den) >= need, 1)
        held = F.coalesce(F.col("decided"), decided) if "decided" in out.columns else decided
        out = met.select("a", "b", "na", "nb", held.alias("decided"))
    return out


def similar_groups(docs: DataFrame, *, k: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by
    links, its own included) for every row of ``docs`` (doc_id, text; other
    columns are ignored).

    Words are runs of bytes other than white space, A-Z in lower case; a
    document is the set of its k-word shingles, or all its words as one if it
    has fewer. Null, empty and blank texts have no shingle and link with
    nothing. Repeated rows are nodes each (equal sets always link); a null
    doc_id never names a component unless all its members are null."""
    return _grouped(docs.withColumn("row_key", F.lit(0).cast("bigint")), k, num, den).select("doc_id", "n_shingles", "component_id")


def _grouped(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``similar_groups`` of ``docs`` (doc_id, text, row_key) with the rows'
    row_key and first_key, that of the component's first row by (doc_id, row_key)."""
    if not 0 < num <= den or k < 1:
        raise ValueError("need k >= 1 and 0 < num/den <= 1")
    every = _sets(docs, k, num, den).checkpoint()
    listed = every.where("skip >= 0")
    sets = listed.select("set_id", F.col("n_shingles").alias("n"), "skip", "tokens").dropDuplicates(["set_id"]).checkpoint()
    postings = _postings(sets, num, den).checkpoint()
    known = _compare(_with_leaders(postings, num, den), sets).checkpoint()
    stars = known.where(_linked(F.col("shared"), num, den)).select("a", "b")
    roots = components(stars)
    rooted = postings.join(roots, postings["set_id"] == roots["node"], "left").select("token", "set_id", "n", "place", F.coalesce("root", "set_id").alias("root"))
    pairs = _derived(_across(rooted, num, den), known, num, den).checkpoint()
    read = _compare(pairs.where("decided is null").select("a", "b", "na", "nb"), sets)
    more = pairs.where("decided = 1").select("a", "b").unionByName(read.where(_linked(F.col("shared"), num, den)).select("a", "b")).checkpoint()
    if not more.isEmpty():
        roots = components(stars.unionByName(more))
    members = listed.select("doc_id", "row_key", "n_shingles", "set_id").join(roots, F.col("set_id") == F.col("node"), "left")
    members = members.select("doc_id", "row_key", "n_shingles", F.coalesce("root", "set_id").alias("root"))
    named = members.groupBy("root").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row_key"))).alias("first"))
    grouped = members.join(named, "root").select("doc_id", "row_key", "n_shingles", F.col("first.doc_id").alias("component_id"), F.col("first.row_key").alias("first_key"))
    alone = every.where("skip < 0").select("doc_id", "row_key", "n_shingles", F.col("doc_id").alias("component_id"), F.col("row_key").alias("first_key"))
    return grouped.unionByName(alone)


def keep_one(docs: DataFrame, *, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one document of every group of near duplicates, the one
    with the smallest doc_id. Rows equal in doc_id and text are one document;
    rows that share an id but not the text are documents of their own. Rows
    with a null id are kept."""
    columns = docs.columns
    named = [c for c in columns if c not in ("doc_id", "text")]
    # other columns under names of our own, so that none clashes with what is added
    rows = docs.select("doc_id", "text", *[F.col(c).alias(f"_in{i}") for i, c in enumerate(named)]).withColumn("row_key", F.xxhash64("text"))
    found = _grouped(rows.select("doc_id", "text", "row_key"), k, num, den)
    kept = found.where("doc_id = component_id and row_key = first_key").select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_k")).distinct()
    one = rows.join(kept, (F.col("doc_id") == F.col("_id")) & (F.col("row_key") == F.col("_k"))).drop("_id", "_k")
    order = F.row_number().over(Window.partitionBy("doc_id", "row_key").orderBy(F.xxhash64(*[c for c in one.columns if isinstance(one.schema[c].dataType, T.AtomicType)])))
    one = one.withColumn("_copy", order).where("_copy = 1").drop("_copy")
    back = [F.col(f"_in{named.index(c)}").alias(c) if c in named else F.col(c) for c in columns]
    return one.unionByName(rows.where("doc_id is null")).select(*back)
