"""The dictionary as a trie and as a minimal automaton, from tokens in order.

In token order, a token adds only the nodes beyond its common prefix with the token before it, so a node belongs to the
first token that has it and is known by that token's rank and its depth: a few bytes, however long the prefix. A range of
the order is read in units of neighbouring tokens. At each depth the tokens of a node stand side by side in a unit, so its
children and what tells its right language are sums over a run. Of the nodes that a unit shares with the token before it,
it passes on what it collected as edge rows, at most one for each depth of its first token; each goes to the last earlier
unit that has a node of its own at that depth. Nothing but these edge rows and the path at a unit's end is shuffled.

A right language is the set of all endings that lead from a node to the end of a token. It is told by the exclusive or of
the endings' 128-bit hashes. Nodes of one right language are one state of the smallest automaton that accepts just the
dictionary, so the states need no rounds from the leaves upwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spinneret.operators.ordering import RANGE, ranked_tokens
from spinneret.session import cut_lineage

# --- Fixed values of the layout -------------------------------------------------------------------------------------
ROOT = "-"
NO_OFFSET = -1
# --------------------------------------------------------------------------------------------------------------------
#: Letters of a unit, one longer token being a unit of its own, and bits of its number within a range.
_UNIT_LETTERS, _UNIT_BITS = 1 << 21, 24
# A node that nothing can be added to; the same, but hanging on an earlier unit's node; one on the path at the end of its
# unit; and what a unit collected for an earlier unit's node.
_COMPLETE, _HANGING, _OPEN, _EDGE = range(4)
_COLUMNS = [
    ("kind", pa.int8()), ("range", pa.int64()), ("slot", pa.int64()), ("depth", pa.int32()), ("val", pa.string()),
    ("is_terminal", pa.bool_()), ("offset", pa.int64()), ("parent", pa.int64()), ("n_children", pa.int64()),
    ("h1", pa.int64()), ("h2", pa.int64()),
]
_WALKED = (
    "kind tinyint, range bigint, slot bigint, depth int, val string, is_terminal boolean, offset bigint, parent bigint,"
    " n_children bigint, h1 bigint, h2 bigint"
)
_NODE = ["slot", "depth", "val", "is_terminal", "offset", "parent", "n_children", "h1", "h2"]


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shared(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many letters each text shares, from the start, with the one before it; none for the first."""
    shared = np.zeros(len(sizes), np.int64)
    left, depth = np.arange(1, len(sizes)), 0
    while len(left):
        left = left[(sizes[left] > depth) & (sizes[left - 1] > depth)]
        left = left[letters[starts[left] + depth] == letters[starts[left - 1] + depth]]
        depth += 1
        shared[left] = depth
    return shared


def _ending_hashes(letters: np.ndarray, starts: np.ndarray, sizes: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each text's ending after each depth; depth d of text t is at ``base[t] + d``."""
    found = np.empty((int((sizes + 1).sum()), 2), np.uint64)
    longest_first = np.argsort(-sizes, kind="stable")
    now = np.empty((len(sizes), 2), np.uint64)
    now[:] = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
    found[base + sizes] = _mixed(now)
    for step in range(1, int(sizes.max(initial=0)) + 1):
        longest_first = longest_first[: np.searchsorted(-sizes[longest_first], -step, side="right")]
        place = sizes[longest_first] - step
        letter = letters[starts[longest_first] + place].astype(np.uint64) + np.uint64(1)
        now[longest_first] = _mixed(now[longest_first] * np.array([0x5851F42D4C957F2D, 0xDA942042E4DD58B5], np.uint64) + letter[:, None])
        found[base[longest_first] + place] = _mixed(now[longest_first])
    return found


def _unit(number: int, before: str, tokens: list[str], slots: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """The nodes of some neighbouring tokens, with edge rows for those that the token ``before`` them has too."""
    raw = [t.encode("utf-32-le", "surrogatepass") for t in [before, *tokens]]
    letters, sizes = np.frombuffer(b"".join(raw), np.uint32), np.array([len(r) // 4 for r in raw])
    starts = np.cumsum(sizes) - sizes
    shared = _shared(letters, starts, sizes)[1:]
    sizes, starts = sizes[1:], starts[1:]
    # A place for each token and depth; sorted by depth, the tokens of a node stand side by side.
    base = np.cumsum(sizes + 1) - (sizes + 1)
    token = np.repeat(np.arange(len(tokens)), sizes + 1)
    depth = np.arange(len(token)) - base[token]
    hashes = _ending_hashes(letters, starts, sizes, base)
    order = np.argsort(depth, kind="stable")
    token, depth = token[order], depth[order]
    begins = np.append(True, depth[1:] != depth[:-1]) | ((shared[token] < depth) & (depth > 0))
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(token)) - 1
    node = np.empty(len(token), np.int64)
    node[order] = np.cumsum(begins) - 1
    owner, deep = token[first], depth[first]
    inherited = (deep == 0) | ((owner == 0) & (deep <= shared[0]))
    above = node[np.maximum(base[owner] + deep - 1, 0)]
    n_children = np.bincount(above[~inherited], minlength=len(first))
    parent = np.where(inherited | inherited[above], -1, slots[owner[above]])
    done = np.where(token[last] == len(tokens) - 1, _OPEN, np.where(parent < 0, _HANGING, _COMPLETE))
    ends = ~inherited & (deep == sizes[owner])
    val = letters[np.maximum(starts[owner] + deep - 1, 0)].copy().view("<U1").astype(object)
    val[deep == 0] = ROOT
    summed = np.bitwise_xor.reduceat(hashes[order], first, axis=0).view(np.int64)
    columns = [
        np.where(inherited, _EDGE, done).astype(np.int8), np.full(len(first), number), np.where(inherited, -1, slots[owner]),
        deep.astype(np.int32), val, ends, np.where(ends, offsets[owner], NO_OFFSET), parent, n_children, summed[:, 0], summed[:, 1],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, _COLUMNS)], [name for name, _ in _COLUMNS])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of one range of tokens, unit by unit."""
    before, unit = None, 0
    for batch in batches:
        tokens = batch.column("token").to_pylist()
        slots, offsets = (batch.column(c).to_numpy() for c in ("slot", "offset"))
        cuts = np.cumsum([len(t) for t in tokens]) // _UNIT_LETTERS
        edges = [0, *(np.flatnonzero(cuts[1:] != cuts[:-1]) + 1).tolist(), len(tokens)] if tokens else []
        for start, end in zip(edges, edges[1:]):
            if before is None:
                before = batch.column("_before_token")[0].as_py() or ""
            number = (batch.column(RANGE)[0].as_py() << _UNIT_BITS) + unit
            yield _unit(number, before, tokens[start:end], slots[start:end], offsets[start:end])
            before, unit = tokens[end - 1], unit + 1


def trie_nodes(token_dict: DataFrame, ranked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(slot, depth, val, is_terminal, offset, parent, n_children, h1, h2)`` and ``(slot, token)`` of ``(token, offset)``.

    A node is the first ``depth`` characters of the token number ``slot``, the first in order that has them. Its parent is
    the node of ``parent`` one character shorter. Without tokens the root is terminal; empty tokens are left out. ``ranked``
    are the :func:`spinneret.operators.ordering.ranked_tokens` of the dictionary, if they are at hand.
    """
    ranked = ranked_tokens(token_dict) if ranked is None else ranked
    last = ranked.groupBy(RANGE).agg(F.max("token").alias("_last"))
    before = last.select(RANGE, F.lag("_last").over(Window.orderBy(RANGE)).alias("_before_token"))
    # One row per range; the broadcast leaves each range where it is, in order.
    told = ranked.join(F.broadcast(before), RANGE).select(RANGE, "slot", "token", "offset", "_before_token")
    walked = cut_lineage(told.mapInArrow(_walk, _WALKED))
    nodes = walked.where(f"kind = {_COMPLETE}").select(*_NODE)
    shared = _joined_edges(walked.where(f"kind <> {_COMPLETE}"))
    spark = token_dict.sparkSession
    bare_root = spark.createDataFrame([(0, 0, ROOT, True, NO_OFFSET, -1, 0, 0, 0)], nodes.schema)
    bare_root = bare_root.join(ranked.limit(1).select(F.lit(0).cast("bigint").alias("slot")), "slot", "left_anti")
    whole = nodes.unionByName(shared).unionByName(bare_root.select(*_NODE))
    return whole, ranked.select("slot", "token")


def _joined_edges(rows: DataFrame) -> DataFrame:
    """The nodes on the paths between units, each with what later units passed on to it.

    An edge row belongs to the last open node of its depth in an earlier unit; depth 0 is the root. The windows go over
    one row per unit and depth.
    """
    earlier = Window.partitionBy("depth").orderBy("range").rangeBetween(Window.unboundedPreceding, -1)
    last_open = F.last(F.when(F.col("kind") == _OPEN, F.col("slot")), ignorenulls=True).over(earlier)
    owner = F.when(F.col("kind") < _EDGE, F.col("slot")).when(F.col("depth") == 0, F.lit(0)).otherwise(last_open)
    named = cut_lineage(rows.withColumn("slot", owner))
    # A node that hangs on an earlier unit's node has that as its parent; its unit has an edge row for it.
    above = named.where(f"kind = {_EDGE}").select("range", (F.col("depth") + 1).alias("depth"), F.col("slot").alias("_above"))
    first = F.col("kind") < _EDGE
    merged = named.groupBy("slot", "depth").agg(
        F.first("val").alias("val"),
        F.bool_or("is_terminal").alias("is_terminal"),
        F.max("offset").alias("offset"),
        F.max(F.when(first, F.col("parent"))).alias("parent"),
        F.min(F.when(first, F.col("range"))).alias("range"),
        F.sum("n_children").alias("n_children"),
        F.bit_xor("h1").alias("h1"),
        F.bit_xor("h2").alias("h2"),
    )
    placed = merged.join(above, ["range", "depth"], "left")
    parent = F.when(F.col("depth") > 0, F.when(F.col("parent") >= 0, F.col("parent")).otherwise(F.col("_above"))).otherwise(F.lit(-1))
    return placed.withColumn("parent", parent.cast("bigint")).select(*_NODE)


def trie(token_dict: DataFrame) -> DataFrame:
    """``(prefix, depth, val, is_terminal, offset, n_children)``: one row per distinct prefix, the root included.

    Spells the prefixes of :func:`trie_nodes`, for reading; what is written are the nodes.
    """
    nodes, tokens = trie_nodes(token_dict)
    spelled = nodes.join(tokens, "slot", "left")
    prefix = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.substring("token", F.lit(1), F.col("depth")))
    return spelled.select(prefix.alias("prefix"), "depth", "val", "is_terminal", "offset", "n_children")


def automaton(token_dict: DataFrame) -> DataFrame:
    """``(state_slot, state_depth, letter, target_slot, target_depth, final)``: the smallest automaton of the dictionary.

    A state is named after the first of its trie nodes, by token and then by depth. ``final`` says that a token may end at
    the target. The start is the state of slot 0 and depth 0, which no token ends at.
    """
    nodes = cut_lineage(trie_nodes(token_dict)[0])
    states = nodes.groupBy("h1", "h2").agg(F.min(F.struct("slot", "depth")).alias("s"), F.bool_or("is_terminal").alias("final"))
    states = cut_lineage(states.select("h1", "h2", F.col("s.slot").alias("state_slot"), F.col("s.depth").alias("state_depth"), "final"))
    children = nodes.where("depth > 0").select(F.col("parent").alias("state_slot"), (F.col("depth") - 1).alias("state_depth"), F.col("val").alias("letter"), "h1", "h2")
    edges = children.join(states.select("state_slot", "state_depth"), ["state_slot", "state_depth"])
    targets = states.select("h1", "h2", F.col("state_slot").alias("target_slot"), F.col("state_depth").alias("target_depth"), "final")
    return edges.join(targets, ["h1", "h2"]).select("state_slot", "state_depth", "letter", "target_slot", "target_depth", "final")
