"""Document fingerprints by one-permutation MinHash with optimal densification (13).

Every shingle of ``words`` words is hashed once. The hash's leading bits name a bin, and each bin keeps its least hash:
one pass of hashing does the work of as many permutations as there are bins. An empty bin borrows from others by
probing: each bin has its own sequence of bins, the same for all documents, and takes the first one in it that is not
empty, so two documents borrow alike where their shingles agree. Sixteen probes are drawn with replacement; a bin that
finds none goes on without, ranking the bins that are not empty by a hash of both, which always ends. Of each bin the
low-order ``bits`` are stored, packed. Unequal bins agree in them by chance once in 2^bits, which the likeness takes off:
(equal - 2^-bits) / (1 - 2^-bits), at least 0.

Words are ``[^\\x20\\x09-\\x0D]+``. A text of fewer words is one shingle, and so is one without words, like all others of
its kind. Everything is DataFrame functions: nothing of a text leaves the JVM.

Results for special input: a null text counts as empty; repeated rows get equal fingerprints; texts of any length are
read whole; an empty table gives no rows; other columns are kept, but for those named like the new ones. Where documents
are put in order, ids must be whole numbers; null ids come first, and documents of one id follow in order of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from platewise.llm.common import pick, width

WORDS, BINS, BITS = 5, 256, 8
PROBES = 16
SPACES = " \t\n\x0b\x0c\r"
#: Blocks of neighbouring ids per shuffle partition.
BLOCKS = 4
_LEAST = -(1 << 63)


def _check(bins: int, bits: int) -> None:
    if bins < 2 or bins & (bins - 1) or bins > 1 << 16 or bits not in (8, 16):
        raise ValueError("bins: a power of two up to 65536; bits: 8 or 16")


def packed(df: DataFrame, text: str, into: str, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``df`` with the binary column ``into``, the fingerprint of ``text`` (never null).

    One projection per step: a later step reads an earlier array several times, so it must be there as a column."""
    _check(bins, bits)
    shift = 64 - (bins.bit_length() - 1)
    most = (1 << shift) - 1
    own = [c for c in df.columns if c != into]

    def step(d: DataFrame, **made: Column) -> DataFrame:
        return d.select(*own, *[c.alias(n) for n, c in made.items()])

    d = step(df, _w=F.transform(F.split(F.btrim(F.col(text), F.lit(SPACES)), "[ \\t-\\r]+"), lambda w: F.xxhash64(w)))
    d = step(d, _s=F.transform(F.sequence(F.lit(0), F.greatest(F.size("_w") - words, F.lit(0))),
                               lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(words)])))
    # the largest hash of each bin ends it and stands for an empty one; bins come in order of the signed hashes
    ends = F.array(*[F.lit(((b - bins // 2) << shift) + most) for b in range(bins)])
    d = step(d, _a=F.sort_array(F.concat("_s", ends)))
    bin_of = lambda x: F.shiftright(x, shift)
    d = step(d, _f=F.filter("_a", lambda x, i: F.coalesce(bin_of(x) != bin_of(F.get("_a", i - 1)), F.lit(True))))
    d = step(d, _v=F.transform("_f", lambda x: F.when(x.bitwiseAND(F.lit(most)) != most, x.bitwiseAND(F.lit((1 << bits) - 1)))))
    d = step(d, _v=F.col("_v"), _u=F.filter(F.transform("_v", lambda v, c: F.struct(c.alias("c"), v.alias("v"))),
                                            lambda x: x["v"].isNotNull()))
    probe = lambda j, t: F.get("_v", F.pmod(F.xxhash64(j, F.lit(t)), F.lit(bins)).cast("int"))
    ranked = lambda j: F.when(F.size("_u") > 0, F.array_min(
        F.transform("_u", lambda x: F.struct(F.xxhash64(j, x["c"], F.lit(-1)).alias("h"), x["v"].alias("v"))))["v"])
    full = F.transform("_v", lambda v, j: F.coalesce(v, *[probe(j, t) for t in range(PROBES)], ranked(j)))
    return step(d, **{into: F.unhex(F.array_join(F.transform(full, lambda v: F.lpad(F.hex(v), bits // 4, "0")), ""))})


def likeness(a: str | Column, b: str | Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated share of common shingles (0 to 1) of two fingerprints of the same ``bins`` and ``bits``."""
    size, chance = bits // 8, 2.0 ** -bits
    part = lambda x, i: F.substr(x, i * size + 1, F.lit(size))
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    equal = F.size(F.filter(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: part(a, i) == part(b, i)))
    return F.greatest(F.lit(0.0), (equal / F.lit(float(bins)) - chance) / F.lit(1 - chance))


def fingerprint(docs: DataFrame, words: int = WORDS, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``docs`` with ``fingerprint`` (binary)."""
    at = [f"_c{i}" for i in range(len(docs.columns))]
    text = F.coalesce(F.col(at[docs.columns.index("text")]).cast("string"), F.lit(""))
    d = packed(docs.toDF(*at).select(*at, text.alias("_text")), "_text", "_print", words, bins, bits)
    keep = [(c, n) for c, n in zip(at, docs.columns) if n.lower() != "fingerprint"]
    return d.select(*[F.col(c).alias(n) for c, n in keep], F.col("_print").alias("fingerprint"))


def with_next(docs: DataFrame, key: str, *carried: str, blocks: int | None = None) -> DataFrame:
    """``docs`` with ``next``, a struct of the ``carried`` columns of the document behind it in order of ``key`` (then of
    those columns); behind the last one comes the first.

    The table is dealt once, to blocks of neighbouring keys cut at approximate quantiles (a bounded list of keys at the
    driver); the documents at a cut also go to the block before it, where they are only looked at."""
    spark = docs.sparkSession
    blocks = blocks or BLOCKS * width(spark)
    keyed = docs.withColumn("_k", F.coalesce(F.col(key).cast("long"), F.lit(_LEAST)))
    cut = keyed.select(F.min("_k").alias("least"), F.percentile_approx(
        "_k", [k / blocks for k in range(blocks)], 10 * blocks).alias("cuts")).first()
    cuts = sorted({cut.least, *cut.cuts}) if cut.least is not None else [0]
    starts, steps = F.array(*map(F.lit, cuts)), [1 << k for k in reversed(range(len(cuts).bit_length()))]
    block = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda lo, s: F.when(
        (lo + s <= len(cuts)) & (F.get(starts, lo + s - 1) <= F.col("_k")), lo + s).otherwise(lo))  # binary search
    dealt = keyed.withColumn("_b", block)
    before = F.when(F.col("_b") > 1, F.col("_b") - 1).otherwise(len(cuts))
    copy = lambda b, ghost: F.struct(b.alias("_block"), F.lit(ghost).alias("_ghost"))
    places = F.when(F.get(starts, F.col("_b") - 1) == F.col("_k"), F.array(copy(F.col("_b"), False), copy(before, True))) \
        .otherwise(F.array(copy(F.col("_b"), False)))
    order = Window.partitionBy("_block").orderBy("_ghost", "_k", *carried)
    out = dealt.select(*docs.columns, "_k", F.inline(places)).withColumn("next", F.lead(F.struct(*carried)).over(order))
    return out.where(~F.col("_ghost")).drop("_k", "_block", "_ghost")


def digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of the documents and of their edited texts, and likenesses, as the registered query returns them."""
    own = pick(docs, "doc_id", "text").withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    near = with_next(packed(own, "text", "print"), "doc_id", "text", "print")
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = near.select("doc_id", n.cast("long").alias("n_chars"), "print", F.col("next.print").alias("next_print"),
                         F.concat(F.substr("text", F.lit(1), n - quarter), F.substr("next.text", F.lit(1), quarter)).alias("edited"))
    both = packed(edited, "edited", "edited_print")
    hexed = lambda c: F.lower(F.hex(c))
    return both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       hexed("print").alias("fingerprint"), hexed("edited_print").alias("edited_fingerprint"),
                       likeness("print", "edited_print").alias("near_edited"), likeness("print", "next_print").alias("near_next"))
