"""Quality rules with a cross-document line frequency, in DataFrame functions only.

Lines that many documents of one host hold (menus, notices, licence lines) are
boilerplate. Lines are normalised (A-Z lower-cased, digits as 0, runs of blanks
as one space) and hashed to 64 bits; per host, the distinct documents that hold
a line are counted (documents with one text count once: copies are for
deduplication); lines above the host's limit are removed; a document of which
too little is left is rejected, and so is one that fails the base rules.

No step needs the rows of a line, a host or a text together. Lines are counted
by partial aggregates; only lines whose plain row count is above the limit have
their documents counted exactly. Rows meet the frequent lines by a join in
which the few hottest lines are broadcast (at most ``HOT`` by construction) and
their rows are spread, so that no join key holds more than one in ``HOT`` rows
of frequent lines; the result returns to the documents by salted keys, as
copies of one text may be a third of all rows.

Nulls: a null text has no words and no lines; a null host is a host of its own;
null or repeated doc_id values play no part, every row gets its own result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabula.session import checkpoint_dir

BLANK, IN_WORD, SYMBOL = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]", "[#*$%&|<>]"
#: At most this many lines are broadcast, each with at least this share of the rows.
HOT = 1000
SALTS = 16
_KEY = ["_host", "_k1", "_k2"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK + "+"), "")


def _same(a: Column, b: Column) -> Column:
    return (a["a"] == b["a"]) & (a["b"] == b["b"]) & (a["c"] == b["c"])


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows found twice or more: windows are sorted with
    their places, equal neighbours are repeats, and every repeat covers up to
    three words that the one before it does not."""
    windows = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.get(words, i).alias("a"), F.get(words, i + 1).alias("b"), F.get(words, i + 2).alias("c"), i.alias("i"))))
    found = _let(windows, lambda s: F.filter(s, lambda x, j: _same(x, F.get(s, j - 1)) | _same(x, F.get(s, j + 1))))
    places = F.sort_array(F.transform(found, lambda x: x["i"]))
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    some = F.size(F.array_distinct(hashes)) < F.size(words) - 2  # else no two windows are equal
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
    covered = F.aggregate(places, start, lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
                          lambda acc: acc["n"])
    return F.when(F.size(words) < 3, F.lit(0).cast("bigint")).when(some, covered).otherwise(F.lit(0).cast("bigint"))


def base_statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(text, F.lit(""))
    dup = _let(F.filter(F.split(text, "\n"), lambda x: x.rlike(IN_WORD)),
               lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))
    return _let(_words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        (F.length(text) - F.regexp_count(text, F.lit(BLANK))).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        dup.cast("bigint").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words")))


def line_hash(line: Column) -> Column:
    """Struct of h, the hash of the normalised line, and n, its words."""
    plain = F.regexp_replace(F.lower(line), "[1-9]", "0")
    return _let(_words(plain), lambda w: F.struct(F.xxhash64(F.array_join(w, " ")).alias("h"), F.size(w).cast("bigint").alias("n")))


def document_lines(text: Column) -> Column:
    """Array of (h, n): the distinct normalised lines of a text that have a
    word, and the words of all their occurrences."""
    lines = F.sort_array(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), line_hash), lambda x: x["n"] > 0))

    def distinct(s: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda j: (j == 0) | (F.get(s, j)["h"] != F.get(s, j - 1)["h"]))
        return _let(firsts, lambda f: F.transform(f, lambda j, t: F.struct(
            F.get(s, j)["h"].alias("h"), (F.get(s, j)["n"] * (F.coalesce(F.get(f, t + 1), F.size(s)) - j)).alias("n"))))
    return _let(lines, lambda s: F.when(F.size(s) > 0, distinct(s)))


def _hold(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """The ``rows`` (_host, h, ...) whose line is one of ``lines`` (_host, h,
    docs), each once."""
    total = lines.agg(F.sum("docs").alias("_all"))  # one row
    marked = lines.crossJoin(F.broadcast(total)).withColumn("_hot", F.col("docs") * HOT >= F.col("_all"))
    hot = marked.where("_hot").select(F.col("_host").alias("_hh"), F.col("h").alias("_ht"), F.lit(True).alias("_hot"))
    cold = marked.where(~F.col("_hot")).select(F.col("_host").alias("_ch"), F.col("h").alias("_ct"), F.lit(True).alias("_cold"))
    met = rows.join(F.broadcast(hot), F.col("_host").eqNullSafe(F.col("_hh")) & (F.col("h") == F.col("_ht")), "left")
    met = met.withColumn("_meet", F.when(F.col("_hot"), F.xxhash64("_k1", "_k2", "h")).otherwise(F.col("h")))
    met = met.join(cold, F.col("_host").eqNullSafe(F.col("_ch")) & (F.col("_meet") == F.col("_ct")), "left")
    return met.where(F.col("_hot") | F.col("_cold")).select(*rows.columns)


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    """``docs`` plus the host and two hashes of the text, which name a text of a host."""
    return docs.withColumns({"_host": F.col(host), "_k1": F.xxhash64("text"), "_k2": F.xxhash64(F.lit(1), "text")})


def frequent_lines(docs: DataFrame, *, host: str = "source", max_docs: int = 10, max_share: float = 0.005) -> DataFrame:
    """Lines to remove: _host, h, docs (distinct documents of the host that hold
    the line), above both ``max_docs`` and ``max_share`` of the host's distinct
    documents. See ``_occurrences`` for the rows that hold them."""
    return _occurrences(_keyed(docs, host), max_docs, max_share)[0]


def _occurrences(keyed: DataFrame, max_docs: int, max_share: float) -> tuple[DataFrame, DataFrame]:
    """(frequent lines, (key, h, n) of every text of a host and line of it whose
    row count is above the limit); both written to the checkpoint folder."""
    checkpoint_dir(keyed.sparkSession)
    rows = keyed.select(*_KEY, F.explode(document_lines(F.col("text"))).alias("line")).select(*_KEY, "line.h", "line.n")
    sizes = keyed.groupBy("_host").agg(F.countDistinct("_k1", "_k2").alias("_size")) \
        .select(F.col("_host").alias("_sh"), F.greatest(F.lit(max_docs), F.floor(F.col("_size") * max_share)).alias("_limit")).checkpoint()

    def above(counted: DataFrame) -> DataFrame:
        near = counted.where(F.col("docs") > max_docs)
        return near.join(sizes, F.col("_host").eqNullSafe(F.col("_sh"))).where(F.col("docs") > F.col("_limit")).select("_host", "h", "docs")

    likely = above(rows.groupBy("_host", "h").agg(F.count("*").alias("docs"))).checkpoint()
    held = _hold(rows, likely).groupBy(*_KEY, "h").agg(F.max("n").alias("n")).checkpoint()
    return above(held.groupBy("_host", "h").agg(F.count("*").alias("docs"))).checkpoint(), held


def judge(docs: DataFrame, *, host: str = "source", keep: list[str] | None = None, max_docs: int = 10, max_share: float = 0.005,
          min_words: int = 50, max_repeated: int = 50, min_left: float = 0.5) -> DataFrame:
    """The columns ``keep`` of ``docs`` (default doc_id), one row per row, plus
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; base_failed
    (fewer than ``min_words`` words, or over ``max_repeated`` per cent of them
    in repeated windows); n_frequent_lines and n_frequent_words (distinct lines
    above the limits and the words of all their occurrences); kept_text (the
    text without those lines, null stays null); kept (neither base_failed nor
    left with a share of words under ``min_left``). Columns in ``keep`` that
    have an added name are left out."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_frequent_lines", "n_frequent_words", "kept_text", "kept"]
    keep = [c for c in (["doc_id"] if keep is None else keep) if c not in added]
    held_columns = list(dict.fromkeys([*keep, host, "text"]))
    named = {c: f"_in{i}" for i, c in enumerate(held_columns)}
    keyed = docs.select(*[F.col(c).alias(n) for c, n in named.items()]).withColumn("text", F.col(named["text"]))
    keyed = _keyed(keyed, named[host])
    lines, held = _occurrences(keyed.select("text", *_KEY), max_docs, max_share)
    found = _hold(held, lines).groupBy(*_KEY).agg(F.count("*").alias("n_frequent_lines"), F.sum("n").alias("n_frequent_words"), F.collect_set("h").alias("_gone"))
    found = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnsRenamed({k: f"_f{k}" for k in _KEY})
    plain = [named[c] for c in keep if isinstance(docs.schema[c].dataType, T.AtomicType)]
    rows = keyed.withColumn("_base", base_statistics(F.col("text"))).withColumn("_salt", F.pmod(F.xxhash64(F.lit(0), *plain), F.lit(SALTS)).cast("int"))
    on = F.col("_host").eqNullSafe(F.col("_f_host")) & (rows["_k1"] == F.col("_f_k1")) & (rows["_k2"] == F.col("_f_k2")) & (rows["_salt"] == found["_salt"])
    rows = rows.join(found, on, "left")
    rows = rows.select("*", "_base.*").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_frequent_lines", "n_frequent_words")})
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    left = F.filter(F.split("text", "\n"), lambda x: _let(line_hash(x), lambda v: (v["n"] == 0) | ~F.array_contains("_gone", v["h"])))
    rows = rows.withColumn("base_failed", failed).withColumn("kept_text", F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("n_frequent_words") >= min_left * F.col("n_words")))
    return rows.select(*[F.col(named[c]).alias(c) for c in keep], *added)
