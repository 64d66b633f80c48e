"""Operator 9: near-duplicates by a min-hash LSH forest.

Each distinct word sequence gets ``VALUES`` min-hash values of its shingle set. A tree of the forest is an order of all
signatures, starting at its own value; texts with a long common prefix lie side by side in it. A region of an order is
a set of texts with a common prefix. Its depth adapts: it starts at ``DEPTHS[0]`` values and goes deeper only where a
prefix is shared by more than ``REGION`` texts. Inside a region each text's candidates are its neighbours of highest
estimated similarity. All candidates are confirmed on the full shingle sets.

Rounds keep the number of candidates in proportion to the texts, also in a region of thousands of near copies: the
first takes each text's ``NEAR`` best neighbours, every later one ``WIDER`` times as many of its best neighbours in other
components, asked from the smaller one. Texts in one component need no further links. A region is done once none of its
texts had more neighbours than it could take, so at the end no candidate of any region is left out. Later rounds
estimate from ``FINE`` further min-hash values, one bit of each, made for the texts of unfinished regions only: where
many texts lie just below the threshold, few of their pairs are left to confirm. In each order only
those neighbours count that no earlier order had in one region with the text.

Texts that leave a crowded prefix at a greater depth are not lost to each other. Once the deeper regions are done, every
crowd whose texts are still in several components is compared as a whole: each text outside its largest component asks
all others. Both sides are cut into blocks, and each block of texts that ask meets each block of the crowd in a region
of its own, with the same rounds. So all pairs of a region of any size are asked, or are in one component without it.
The cost is linear in a crowd of near copies, and quadratic in the texts of a crowd that no link joins.

Exact copies are one text throughout. A prefix so common that the whole signature is shared by more than ``REGION``
texts is cut into blocks, and each block gets the least text of all as a member, so the blocks stay connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spinneret.llm.common import components
from spinneret.llm.shingles import minhash_parameters, minhashes, shingle_set, text_key
from spinneret.session import cut_lineage

VALUES, TREES = 128, 16
DEPTHS = (4, 6, 8, 12, 16, 32, 64, 128)
REGION, NEAR, WIDER = 2_000, 4, 8
FINE = 4_096
#: Document numbers that are broadcast; of 8 bytes each.
SMALL_IDS = 1 << 20
#: Standard errors by which an estimate may fall short of the similarity asked for; small sets spread the fine one more.
SLACK, FINE_SLACK = 3.5, 5.0


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """``(doc_id, k1, k2, n_shingles, sig)``: the key of the word sequence, the size of its set, its signature."""
    factors, masks = minhash_parameters(VALUES)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, width) for t in batch["text"]]
            keys = [text_key(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "k1": [k[0] for k in keys], "k2": [k[1] for k in keys],
                "n_shingles": [len(s) for s in sets], "sig": [s.tobytes() for s in minhashes(sets, factors, masks)],
            })

    told = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    made = told.mapInPandas(rows, "doc_id string, k1 bigint, k2 bigint, n_shingles bigint, sig binary")
    return made.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _keyed(rows: DataFrame, depth: int) -> DataFrame:
    """The region of each text at a depth: a hash of the tree and of the prefix that starts at the tree's own value."""
    prefix = f"substring(concat(sig, sig), {2 * VALUES // TREES} * tree + 1, {2 * depth})"
    return rows.select("rep", "tree", F.expr(f"xxhash64(tree, {depth}, {prefix})").alias("region"))


def regions(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``(region, tree, rep, size, crowded, side)`` over all trees, each region with 2 to ``REGION`` + 1 of ``texts(rep, sig)``.

    ``crowded`` says that one of the text's prefixes at the first depth is shared by more than ``REGION`` texts; these
    crowds come second, as ``(region, tree, rep)``, if there are any. ``side`` is 0: each text may ask each other.
    """
    rows = texts.select("rep", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    found, crowds = [], None
    for depth in DEPTHS:
        keyed = _keyed(rows, depth)
        sizes = keyed.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("first")).where("size > 1")
        shared = cut_lineage(keyed.join(sizes, "region"))
        found.append(shared.where(F.col("size") <= REGION).select("region", "tree", "rep", "size"))
        crowded = shared.where(F.col("size") > REGION)
        if crowded.isEmpty():
            break
        crowds = crowded.select("region", "tree", "rep") if crowds is None else crowds
        rows = crowded.select("rep", "tree").join(texts, "rep")
    else:
        block = F.expr(f"pmod(xxhash64(rep), cast(ceil(2 * size / {REGION}) as int))")
        blocks = crowded.withColumn("region", F.xxhash64("region", block))
        pivots = blocks.select("region", "tree", F.col("first").alias("rep"), "size")
        found.append(blocks.select("region", "tree", "rep", "size").unionByName(pivots).distinct())
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    whole = whole.withColumn("side", F.lit(0))
    if crowds is None:
        return whole.withColumn("crowded", F.lit(False)), None
    marked = whole.join(crowds.select("rep").distinct().withColumn("_crowded", F.lit(True)), "rep", "left")
    return marked.withColumn("crowded", F.coalesce("_crowded", F.lit(False))).drop("_crowded"), crowds


def crossings(crowds: DataFrame) -> DataFrame:
    """Members of new regions, in which the texts of ``crowds(region, tree, rep, comp)`` meet those of other components.

    On ``side`` 1 are texts outside the crowd's largest component, on side 2 all texts of the crowd; each of the former
    is in one region with each of the latter. A region has about ``REGION`` texts of each side.
    """
    sizes = crowds.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("region").agg(F.max(F.struct("n", "comp")).alias("largest"), F.sum("n").alias("size")).where("size > largest.n")
    sizes = cut_lineage(sizes.select(
        "region", F.col("largest.comp").alias("main"),
        F.ceil((F.col("size") - F.col("largest.n")) / REGION).cast("int").alias("rows"), F.ceil(F.col("size") / REGION).cast("int").alias("cols"),
    ))
    met = crowds.join(F.broadcast(sizes) if sizes.count() <= SMALL_IDS else sizes, "region")
    row, col = F.expr("pmod(xxhash64(rep, 1), rows)").alias("row"), F.expr("pmod(xxhash64(rep, 2), cols)").alias("col")
    asking = met.where("comp <> main").select("region", "tree", "rep", row, F.expr("explode(sequence(0, cols - 1))").alias("col"), F.lit(1).alias("side"))
    asked = met.select("region", "tree", "rep", F.expr("explode(sequence(0, rows - 1))").alias("row"), col, F.lit(2).alias("side"))
    # What an earlier tree has in one region, crowded or not, is asked there, so no text counts as crowded here.
    return asking.unionByName(asked).select(
        F.expr("xxhash64(region, int(row), int(col))").alias("region"), "tree", "rep", F.lit(False).alias("crowded"), "side"
    )


def fine_sketch(texts: DataFrame, width: int) -> DataFrame:
    """``(rep, fine)`` of ``texts(rep, text)``: one bit, the parity, of each of ``FINE`` min-hash values."""
    factors, masks = minhash_parameters(FINE, seed=2)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = minhashes([shingle_set(t, width) for t in batch["text"]], factors, masks)
            bits = np.packbits(np.bitwise_count(values) & 1, axis=1)
            yield pd.DataFrame({"rep": batch["rep"], "fine": [b.tobytes() for b in bits]})

    return texts.select("rep", "text").mapInPandas(rows, "rep bigint, fine binary")


def likeness(some: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Estimated similarities, from rows of 16-bit values or from rows of 64 bits of the fine sketch at a time."""
    if some.dtype == np.uint64:
        return 1 - 2 / FINE * np.bitwise_count(some ^ other).sum(axis=-1)
    return (some == other).mean(axis=-1)


def least_likeness(share: float, fine: bool) -> float:
    """The estimate that texts of a true similarity ``share`` hardly ever fall short of."""
    if fine:
        return share - FINE_SLACK * ((1 - share) * (1 + share) / FINE) ** 0.5
    return share - SLACK * (share * (1 - share) / VALUES) ** 0.5


def _pairs_of(rows: pd.DataFrame, sig: np.ndarray, marks: np.ndarray, least: float, most: int) -> tuple[list, list, list]:
    """Candidate pairs of whole regions, given in order: the best fresh neighbours of each text in other components.

    ``marks`` are what similarities are estimated from. The third list has the regions where a text had more than
    ``most`` neighbours.
    """
    region, rep, comp, crowded = (rows[c].to_numpy() for c in ("region", "rep", "comp", "crowded"))
    tree, side = rows["tree"].to_numpy(), rows["side"].to_numpy()
    # The first prefixes of all trees; a pair that shares an earlier one has met there, unless that tree went deeper.
    prefix = np.ascontiguousarray(sig.reshape(len(sig), TREES, VALUES // TREES)[:, :, : DEPTHS[0]]).view(np.uint64)[:, :, 0]
    left, right, unfinished = [], [], []
    starts = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
    ends = np.append(starts[1:], len(region))
    two = starts[ends - starts == 2]
    alike = (likeness(marks[two], marks[two + 1]) >= least) & (comp[two] != comp[two + 1])
    met = ((prefix[two] == prefix[two + 1]) & (np.arange(TREES) < tree[two][:, None])).any(axis=1)
    alike &= ~met | crowded[two] | crowded[two + 1]
    alike &= (side[two] == 0) | (side[two] != side[two + 1])
    left.append(rep[two[alike]])
    right.append(rep[two[alike] + 1])
    for start, end in zip(starts, ends):
        if end - start < 3:
            continue
        block, own, ids, full = marks[start:end], comp[start:end], rep[start:end], crowded[start:end]
        earlier = prefix[start:end, : tree[start]]
        _, group, sizes = np.unique(own, return_inverse=True, return_counts=True)
        weight, more, sides = sizes[group], False, side[start:end]
        for row in np.flatnonzero(sides < 2):
            fresh = ~(earlier == earlier[row]).any(axis=1) | full | full[row]
            open_to = sides == 2 if sides[row] else weight >= weight[row]
            asked = np.flatnonzero(fresh & (own != own[row]) & open_to)
            alike = likeness(block[asked], block[row])
            near, alike = asked[alike >= least], alike[alike >= least]
            if len(near) > most:
                more = True
                near = near[np.argsort(-alike, kind="stable")[:most]]
            left.append(np.full(len(near), ids[row]))
            right.append(ids[near])
        if more:
            unfinished.append(region[start])
    return left, right, unfinished


def candidates(members: DataFrame, texts: DataFrame, percent: int, most: int, fine: bool = False) -> DataFrame:
    """``(a, b, region)`` from ``members(region, tree, rep, comp, crowded, side)``: pairs a < b, and regions with more to ask.

    A row is one or the other; ``texts`` has ``(rep, sig)``, and ``fine`` where that is asked for. Regions are compared as they stream by, one at a time.
    """
    least = least_likeness(percent / 100, fine)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in _with_end(batches):
            if batch is not None:
                held = batch if held is None else pd.concat([held, batch], ignore_index=True)
                cut = int(np.searchsorted(held["region"].to_numpy(), held["region"].iloc[-1]))
            elif held is None:
                return
            else:
                cut = len(held)
            now, held = held.iloc[:cut], held.iloc[cut:]
            if not len(now):
                continue
            sig = np.frombuffer(b"".join(now["sig"]), np.uint16).reshape(len(now), VALUES)
            marks = np.frombuffer(b"".join(now["fine"]), np.uint64).reshape(len(now), FINE // 64) if fine else sig
            pairs = _pairs_of(now, sig, marks, least, most)
            a, b = np.concatenate(pairs[0]), np.concatenate(pairs[1])
            yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "region": None}).drop_duplicates()
            yield pd.DataFrame({"a": None, "b": None, "region": pairs[2]})

    rows = members.join(texts, "rep").select("region", "tree", "rep", "comp", "crowded", "side", "sig", *["fine"] * fine)
    rows = rows.repartition("region").sortWithinPartitions("region", "rep")
    return rows.mapInPandas(compare, "a bigint, b bigint, region bigint").distinct()


def _with_end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame | None]:
    yield from batches
    yield None


def _texts_of(docs: DataFrame, ids: DataFrame, n_ids: int) -> DataFrame:
    """``(doc_id, text)`` of ``ids(doc_id)``; of a repeated doc_id with different texts the least stands for it."""
    ids = F.broadcast(ids.distinct()) if n_ids <= SMALL_IDS else ids.distinct()
    return docs.select("doc_id", "text").join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have 100 * intersection >= percent * union."""
    texts = _texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), 2 * pairs.count())

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for one, other in zip(batch["text_a"], batch["text_b"]):
                x, y = shingle_set(one, width), shingle_set(other, width)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(len(x) > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[linked, ["a", "b"]]

    joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    joined = joined.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return joined.select("a", "b", "text_a", "text_b").mapInPandas(check, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked if their sets of ``width``-word shingles, A-Z lower-cased, have 100 * intersection >= percent
    * union; ``component_id`` is the smallest doc_id that links reach. A text with fewer words than ``width`` is one
    shingle; a null or empty one has none and is linked with nothing. A null doc_id is never the smallest: such a row
    belongs to its copies' component, and has a null one if it has no copy with an id or no words. Repeated rows get equal results. Other
    columns of ``docs`` play no part.
    """
    return _resolved(docs, width, percent).select("doc_id", "n_shingles", "component_id", "kept")


def _linked(members: DataFrame, crowds: DataFrame | None, texts: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(id, component)`` of the texts with links: first inside regions, then across the crowds that are still split."""
    comps, tried = _rounds(members, None, None, texts, docs, width, percent)
    if crowds is None:
        return comps
    across = cut_lineage(crossings(cut_lineage(_placed(crowds, comps))))
    return comps if across.isEmpty() else _rounds(across, comps, tried, texts, docs, width, percent)[0]


def _placed(members: DataFrame, comps: DataFrame | None) -> DataFrame:
    """The members with the component ``comp`` that each is in so far."""
    if comps is None:
        return members.withColumn("comp", F.col("rep"))
    named = members.join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    return named.select(*members.columns, F.coalesce("component", "rep").alias("comp"))


def _rounds(
    members: DataFrame, comps: DataFrame | None, tried: DataFrame | None, texts: DataFrame, docs: DataFrame, width: int, percent: int
) -> tuple[DataFrame, DataFrame]:
    """The components and the pairs tried, after rounds of ever more candidates until no region has more to ask."""
    left, most, fine = _placed(members, comps), NEAR, None
    while True:
        asked = cut_lineage(candidates(left, texts, percent, most) if fine is None else candidates(left, fine, percent, most, fine=True))
        new = asked.where("region is null").select("a", "b")
        if tried is not None:
            new = cut_lineage(new.join(tried, ["a", "b"], "left_anti"))
        tried = new if tried is None else tried.unionByName(new)
        links = confirmed(new, docs, width, percent)
        if comps is None:
            comps = cut_lineage(components(links))
        elif not (links := cut_lineage(links)).isEmpty():
            # A component is a star around its least id, so the new links are all that has to be contracted.
            stars = comps.where("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b"))
            comps = cut_lineage(components(stars.unionByName(links)))
        unfinished = asked.where("region is not null").select("region").distinct()
        left = cut_lineage(_placed(members.join(unfinished, "region", "left_semi"), comps))
        split = left.groupBy("region").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
        if split.isEmpty():
            return comps, tried
        most *= WIDER
        left = cut_lineage(left.join(split.select("region"), "region", "left_semi"))
        if fine is None:
            ids = left.select(F.col("rep").alias("doc_id")).distinct()
            shown = _texts_of(docs, ids, left.count()).withColumnRenamed("doc_id", "rep")
            fine = cut_lineage(fine_sketch(shown, width).join(texts, "rep"))


def _resolved(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The result with the keys ``k1, k2`` of the word sequences."""
    sketches = cut_lineage(sketch(docs, width))
    worded = sketches.where("n_shingles > 0")
    groups = cut_lineage(worded.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig")).where("rep is not null"))
    texts = groups.groupBy("rep").agg(F.min("sig").alias("sig"))
    members, crowds = regions(texts)
    comps = _linked(cut_lineage(members), crowds, texts, docs, width, percent)
    named = groups.select("k1", "k2", "rep").join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("k1", "k2", F.coalesce("component", "rep").alias("component_id"))
    found = sketches.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.select("doc_id", "n_shingles", "k1", "k2", own.alias("component_id"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with its own columns; of the rows of one doc_id one stays.

    Of rows without an id that have the same words one stays, unless a row with an id has them too; those without words
    all stay.
    """
    found = cut_lineage(_resolved(docs, width, percent))
    named = found.where("kept and doc_id is not null")
    rest = docs.join(named.select("doc_id").distinct(), "doc_id", "left_semi").select(*docs.columns)
    n_rows, n_ids = named.agg(F.count(F.lit(1)), F.countDistinct("doc_id")).first()
    if n_rows > n_ids:
        rest = rest.dropDuplicates(["doc_id"])
    if found.where("doc_id is null").isEmpty():
        return rest

    @F.pandas_udf("struct<k1: bigint, k2: bigint>")
    def key(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_key(t) for t in texts], columns=["k1", "k2"])

    nameless = docs.where("doc_id is null").select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    nameless = nameless.withColumn("key", key(F.coalesce("doc.text", F.lit("")))).select("doc", "key.k1", "key.k2")
    worded = nameless.where("k1 <> 0 or k2 <> 0").dropDuplicates(["k1", "k2"])
    worded = worded.join(found.where("doc_id is not null").select("k1", "k2").distinct(), ["k1", "k2"], "left_anti")
    blank = nameless.where("k1 = 0 and k2 = 0")
    return rest.unionByName(worded.select("doc.*")).unionByName(blank.select("doc.*"))


#: The same as :func:`near_duplicates` for 3 words and 85 %, as a join of all shingles.
NEAR_DUPS_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE
      WHEN words IS NULL OR len(words) = 0 THEN []::VARCHAR[]
      WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingles
  FROM w
), e AS (
  SELECT doc_id, unnest(shingles) AS shingle FROM s
), p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM e x JOIN e y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.shingles) + len(y.shingles) - n)
), u AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r AS (
  SELECT doc_id AS id, doc_id AS reached FROM documents
  UNION
  SELECT r.id, u.b FROM r JOIN u ON u.a = r.reached
), c AS (
  SELECT id, min(reached) AS component_id FROM r GROUP BY id
)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN c ON c.id = s.doc_id
"""
