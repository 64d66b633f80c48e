"""Operator 1: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Of a uniform permutation of all rows, cut into shards of fixed sizes, only the counts matter between partitions: how
many rows each partition sends to each shard. Those counts follow a multivariate hypergeometric law. They are drawn
first; then each partition permutes its rows locally and deals the first of them to shard 0, the next to shard 1 and so
on as the matrix says; after the exchange each shard is permuted again. The outcome is a uniform shuffle.

The matrix is drawn down a tree of partitions with 64 children a node: a node's children divide the node's counts, one
after the other, and the nodes of a level are independent rows. So the depth is log64 of the number of partitions and
no task sees more than 64 rows of the matrix at once. A single hypergeometric number comes from inverting its
distribution function in a window of nine standard deviations around the mode; what lies outside has a probability
below 1e-17, less than the uniform numbers resolve.

Everything is DataFrame and SQL functions. The only broadcast is the matrix while it has at most ``SMALL_MATRIX``
entries; a larger one is joined by a shuffle on the partition number, whose groups are single partitions' rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.common import ROW, packed
from spinneret.operators.ordering import in_ranges, rank_rows
from spinneret.session import cut_lineage

N_SHARDS = 16
FAN_OUT = 64
#: Entries of a matrix that is broadcast; of 8 bytes each, 32 MB.
SMALL_MATRIX = 1 << 22
_ROW_BITS = 33


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric(good: str, bad: str, draws: str, uniform: str) -> str:
    """SQL text of one draw: how many of ``draws`` items without replacement are among the ``good`` ones.

    ``good``, ``bad`` and ``draws`` are BIGINT expressions, ``uniform`` a DOUBLE strictly between 0 and 1. The masses of the
    window are taken relative to the mode's, as products of the ratios of neighbours, and divided by their own sum; no
    large numbers are subtracted, so the law keeps its precision at any count.
    """
    def ratio(i: str) -> str:
        """The mass of ``i`` + 1 over that of ``i``."""
        return f"double(v.a - {i}) * double(v.n - {i}) / (double({i} + 1) * double(v.b - v.n + {i} + 1))"

    def summed(steps: str, factor: str) -> str:
        add = _let("m", f"z.p * {factor}", "named_struct('p', m, 's', z.s + m)")
        return f"if({steps} > 0, aggregate(sequence(1L, {steps}), named_struct('p', 1D, 's', 0D), (z, i) -> {add}), named_struct('p', 1D, 's', 0D))"

    below = summed("q.mode - q.lo", f"(1D / ({ratio('(q.mode - i)')}))")
    above = summed("q.hi - q.mode", f"({ratio('(q.mode + i - 1)')})")
    walk = (
        f"aggregate(sequence(q.lo, q.hi), named_struct('cum', 0D, 'p', d.p / (1D + d.s + e.s), 'k', q.lo),"
        f" (z, i) -> if(z.cum >= v.u, z, named_struct('cum', z.cum + z.p, 'p', z.p * {ratio('i')}, 'k', i)), z -> z.k)"
    )
    bounds = "named_struct('lo', greatest(v.n - v.b, 0L, w.mode - w.reach), 'hi', least(v.n, v.a, w.mode + w.reach), 'mode', w.mode)"
    clamped = "named_struct('lo', r.lo, 'hi', r.hi, 'mode', least(greatest(r.mode, r.lo), r.hi))"
    around = (
        "named_struct('mode', bigint(floor((v.n + 1D) * (v.a + 1D) / (v.a + v.b + 2D))), 'reach', 12L + bigint(ceil(9D * sqrt("
        "greatest(0D, double(v.n) * v.a / (v.a + v.b) * v.b / (v.a + v.b) * (v.a + v.b - v.n) / greatest(1D, v.a + v.b - 1D))))))"
    )
    drawn = _let("w", around, _let("r", bounds, _let("q", clamped, _let("d", below, _let("e", above, walk)))))
    given = f"named_struct('a', bigint({good}), 'b', bigint({bad}), 'n', bigint({draws}), 'u', {uniform})"
    sure = "greatest(v.n - v.b, 0L) = least(v.n, v.a)"
    return _let("v", given, f"if({sure}, least(v.n, v.a), {drawn})")


def _uniform(seed: int, *parts: str) -> str:
    """A number strictly between 0 and 1 from a hash of its place in the matrix."""
    return f"(double(shiftrightunsigned(xxhash64({seed}L, {', '.join(parts)}), 12)) + 0.5D) / 4503599627370496D"


def _divide(level: int, n_shards: int, seed: int) -> str:
    """SQL text: the children ``kids(node, n)`` take their rows of the matrix from the parent's ``cols``."""
    one = hypergeometric("element_at(s.cap, j + 1)", "t.pool - element_at(s.cap, j + 1)", "t.left", _uniform(seed, f"{level}", "kid.node", "j"))
    step = _let(
        "x", one,
        "named_struct('left', t.left - x, 'pool', t.pool - element_at(s.cap, j + 1), 'took', concat(t.took, array(x)))",
    )
    start = "named_struct('left', kid.n, 'pool', aggregate(s.cap, 0L, (m, c) -> m + c), 'took', cast(array() as array<bigint>))"
    row = f"aggregate(sequence(0, {n_shards - 1}), {start}, (t, j) -> {step}, t -> t.took)"
    state = "named_struct('cap', cols, 'out', cast(array() as array<struct<node: bigint, cols: array<bigint>>>))"
    after = (
        "named_struct('cap', zip_with(s.cap, d, (c, x) -> c - x),"
        " 'out', concat(s.out, array(named_struct('node', kid.node, 'cols', d))))"
    )
    return f"aggregate(kids, {state}, (s, kid) -> {_let('d', row, after)}, s -> s.out)"


def shard_sizes(n_rows: int, n_shards: int) -> list[int]:
    """At most one apart, the larger ones first."""
    return [n_rows // n_shards + (j < n_rows % n_shards) for j in range(n_shards)]


def communication_matrix(counts: DataFrame, n_shards: int, seed: int = 0) -> DataFrame:
    """``(node, cols)``: for each partition of ``counts(node, n)`` how many of its rows go to each shard.

    Each row sums to the partition's ``n`` and the columns to the shard sizes.
    """
    total, last = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("node"), F.lit(0))).first()
    levels = [counts]
    while last > 0:
        last //= FAN_OUT
        levels.append(levels[-1].groupBy(F.shiftright("node", 6).alias("node")).agg(F.sum("n").alias("n")))
    caps = ", ".join(f"{x}L" for x in shard_sizes(total, n_shards))
    if len(levels) == 1:
        return counts.select("node", F.expr(f"array({caps})").alias("cols"))
    nodes = levels[-1].select("node", F.expr(f"array({caps})").alias("cols"))
    for level in reversed(range(len(levels) - 1)):
        kids = levels[level].groupBy(F.shiftright("node", 6).alias("parent")).agg(
            F.sort_array(F.collect_list(F.struct("node", "n"))).alias("kids")
        )
        drawn = nodes.join(kids, nodes["node"] == kids["parent"]).select(
            F.explode(F.expr(_divide(level, n_shards, seed))).alias("kid")
        )
        nodes = cut_lineage(drawn.select("kid.node", "kid.cols"))
    return nodes


def deal(rows: DataFrame, n_shards: int = N_SHARDS, seed: int = 0) -> DataFrame:
    """The rows with ``shard`` and ``slot`` (0-based place in the shard), a uniform shuffle over all rows.

    Shard sizes are at most one apart. Rows are written twice on the way, so give the columns that decide and no
    texts; :func:`shard_table` brings whole rows along. Rows stay rows: null keys, repeated rows and ties are dealt as any
    other, and an empty table gives an empty result. Columns of the names ``shard`` and ``slot`` are replaced.
    """
    keep = [c for c in rows.columns if c not in ("shard", "slot")]
    # The local permutation. The tag holds the partition and the place in it, and is fixed by the checkpoint.
    mixed = rows.select(*keep, F.rand(seed).alias("_draw")).sortWithinPartitions("_draw")
    tagged = cut_lineage(mixed.select(*keep, F.monotonically_increasing_id().alias("_tag")))
    chunk = F.shiftright("_tag", _ROW_BITS)
    counts = cut_lineage(tagged.groupBy(chunk.alias("node")).agg(F.count(F.lit(1)).alias("n")))
    matrix = communication_matrix(counts, n_shards, seed)
    bounds = F.expr(f"transform(sequence(1, {n_shards}), j -> aggregate(slice(cols, 1, j), 0L, (m, c) -> m + c))")
    matrix = matrix.select("node", bounds.alias("_bounds"))
    n_chunks, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n_chunks * n_shards <= SMALL_MATRIX:
        matrix = F.broadcast(matrix)
    place = F.col("_tag").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    dealt = tagged.withColumn("node", chunk).join(matrix, "node").withColumn("_place", place)
    dealt = dealt.withColumn("shard", F.expr("cast(size(filter(_bounds, b -> b <= _place)) as int)"))
    # The exchange and the second permutation: a sort on fresh random numbers inside each shard, over many tasks.
    mixed = dealt.select(*keep, "shard", F.xxhash64(F.lit(seed + 1), "_tag").alias("_mix"), "_tag")
    ranked = rank_rows(in_ranges(mixed, "shard", "_mix", "_tag"), "_rank")
    start = F.col("shard") * F.lit(total // n_shards) + F.least("shard", F.lit(total % n_shards))
    return ranked.select(*keep, "shard", (F.col("_rank") - start).cast("bigint").alias("slot"))


def shard_table(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = 0) -> DataFrame:
    """All columns of a table scan with ``shard`` and ``slot``, laid out in that order.

    Only row numbers are dealt; the rows themselves are joined to their places and ordered, two exchanges in all.
    ``docs`` must be a scan (see :func:`spinneret.llm.common.with_row`); write any other frame first.
    """
    keep = [f"doc.{c}" for c in docs.columns if c not in ("shard", "slot")]
    rows = packed(docs)
    placed = rows.join(deal(rows.select(ROW), n_shards, seed), ROW).repartitionByRange("shard", "slot")
    return placed.sortWithinPartitions("shard", "slot").select(*keep, "shard", "slot")


def shard_digest(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = 0) -> DataFrame:
    """One row per document: its size, checksum, shard and slot. A null text has size 1 and the checksum of no bytes."""
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = docs.select("doc_id", (F.octet_length(raw).cast("bigint") + 1).alias("size"), F.crc32(raw).alias("text_crc32"))
    placed = deal(narrow, n_shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
