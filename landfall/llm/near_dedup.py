"""Near duplicates: a similarity join of shingle sets by the chosen-path method.

Documents with one and the same set of word shingles are one class; a class is
compared, not its copies. Independent trees deal the classes into nodes: a class goes to
the node of the minwise token that the tree has chosen. A node of bounded size
is compared exhaustively by minwise sketches; a larger one first hangs its members on
one leader, is closed if that already connects them, and otherwise branches again by
two further tokens. Every link is confirmed on the full sets. Trees repeat until a pair at
the threshold is missed less than once in 10^5 (``trees``).

At similarity s a class pair meets in a tree's first node with chance s and survives each
further branching with two children in 0.89 of the cases at s = 0.75 (the extinction
probability q solves q = (1 - s + s q)^2), so at least 0.67 per tree at any depth: twelve trees
miss 2 in 10^6. A sketch of 128 tokens keeps a pair if 74 agree; at 0.75 fewer do in
about 3 of 10^6 pairs. Nothing is capped: a node that is still too large after the last
branching is compared block by block.

Nodes propose members, not pairs: whoever resembles another of a node, once per tree that
first brings the two together, and the leader it surely resembles. Leaders are confirmed first;
a node whose members that leaves unconnected compares their full sets in its task and gives
the links that connect them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm import arrays
from landfall.llm.common import Steps, text_rows, which_text
from landfall.llm.graph import components
from landfall.operators.joins import splittable

SHINGLE = 5
THRESHOLD = 75          # per cent: 100 * intersection >= THRESHOLD * union
TREES = 12
SKETCH = 128            # minwise tokens of 8 bits each
SURE, POSSIBLE = 90, 74  # agreeing tokens: taken as a leader's, worth confirming
NODE = 2048             # classes compared exhaustively in one task,
NODE_SHINGLES = 2_000_000  # and shingles that they may have in all
DEPTH = 6
MARKS = 1 << 26         # bits that tell which rows' texts are wanted: 8 MB at most go to each executor
_HELD = 4_000_000       # shingles of texts that a confirming task keeps
_MULTIPLIERS = arrays.mix(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_set(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; its words as one if it has fewer."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(text.translate(arrays.LOWER), np.uint8)
    words = arrays.word_hashes(raw, *arrays.word_spans(raw))
    return np.unique(arrays.gram_hashes(words, min(size, len(words)))) if len(words) else words


def _tokens(members: np.ndarray) -> np.ndarray:
    """For each of the sketch's hash functions the least hash over the set."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(members), 1024):
        part = members[start:start + 1024, None] * _MULTIPLIERS[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return arrays.mix(least)


def _describe(size: int, trees: int):
    schema = pa.schema([("_id", pa.int64()), ("which", pa.int32()), ("n", pa.int64()),
                        ("h1", pa.int64()), ("h2", pa.int64()), ("sketch", pa.binary()),
                        ("tokens", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h1, h2, sketches, tokens = [], [], [], [], []
            for text in arrays.raw_texts(batch.column("_text")):
                members = shingle_set(text, size)
                n.append(len(members))
                h1.append(int(members.sum(dtype=np.uint64).view(np.int64)))
                h2.append(int(arrays.mix(members ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64).view(np.int64)))
                if len(members):
                    least = _tokens(members)
                    sketches.append((least >> np.uint64(56)).astype(np.uint8).tobytes())
                    tokens.append(arrays.mix(least[:trees]).view(np.int64).tolist())
                else:
                    sketches.append(None)
                    tokens.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("which"), pa.array(n, pa.int64()),
                 pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(sketches, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))],
                schema=schema)

    return run, "_id long, which int, n long, h1 long, h2 long, sketch binary, tokens array<long>"


def describe(rows: DataFrame, size: int, trees: int) -> DataFrame:
    """Per document the size of its set, the set's identity, its sketch and the trees' tokens."""
    run, schema = _describe(size, trees)
    return rows.select("_id", which_text().alias("which"), "_text").mapInArrow(run, schema)


def _agreeing(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many tokens each sketch of the left has in common with each of the right."""
    out = np.zeros((len(left), len(right)), np.uint8)
    left, right = np.ascontiguousarray(left.T), np.ascontiguousarray(right.T)
    for mine, theirs in zip(left, right):
        out += mine[:, None] == theirs[None, :]
    return out


def _blocks_of(sketches: np.ndarray):
    for start in range(0, len(sketches), 256):
        yield start, _agreeing(sketches[start:start + 256], sketches)


class _Node:
    """The classes of one node: ids, set sizes, trees that compare them, tree, tokens, sketches."""

    def __init__(self, columns: list[np.ndarray], share: float):
        order = np.argsort(columns[0], kind="stable")
        self.ids, self.sizes, self.met, self.tree, self.tokens, self.sketches = (
            column[order] for column in columns)
        self.share = share

    def fits(self, i, j):
        """Whether the sizes allow the threshold at all."""
        return (np.minimum(self.sizes[i], self.sizes[j])
                >= self.share * np.maximum(self.sizes[i], self.sizes[j]))

    def proposed(self) -> np.ndarray:
        """``(member, leader)`` of each member that resembles another which no earlier tree has
        compared it with. The leader is whoever surely resembles most, the least id among
        equals; a member without one is its own."""
        count = len(self.ids)
        marked, many = np.zeros(count, bool), np.zeros(count, np.int64)
        for start, counts in _blocks_of(self.sketches):
            many[start:start + len(counts)] = (counts >= SURE).sum(axis=1)
            i, j = np.nonzero(counts >= POSSIBLE)
            i += start
            i, j = i[j > i], j[j > i]
            keep = self.fits(i, j)
            i, j = i[keep], j[keep]
            both = self.met[i] & self.met[j] & ((1 << np.minimum(self.tree[i], 62)) - 1)
            for t in range(self.tokens.shape[1]):
                both &= ~np.where(self.tokens[i, t] == self.tokens[j, t], 0, 1 << t)
            marked[i[both == 0]] = marked[j[both == 0]] = True
        leader = np.arange(count)
        free = marked.copy()
        for i in np.lexsort((self.ids, -many)):
            if many[i] == 1:
                break
            if free[i]:
                rest = np.flatnonzero(free)
                near = rest[(self.sketches[rest] == self.sketches[i]).sum(axis=1) >= SURE]
                near = near[self.fits(near, i)]
                free[near] = False
                leader[near] = i
        return np.stack([self.ids[marked], self.ids[leader[marked]]], axis=1)


def _groups(batches: Iterator[pa.RecordBatch], columns) -> Iterator[tuple[int, list]]:
    """The rows of each node, from batches sorted by node; ``columns`` makes arrays of a batch,
    the node first."""
    held: list[list] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        data = columns(batch)
        cuts = [0, *(np.flatnonzero(np.diff(data[0])) + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if held and held[0][0][0] != data[0][start]:
                yield held[0][0][0], [np.concatenate(part) for part in zip(*held, strict=True)][1:]
                held = []
            held.append([column[start:end] for column in data])
    if held:
        yield held[0][0][0], [np.concatenate(part) for part in zip(*held, strict=True)][1:]


def _compare_nodes(share: float):
    """Over rows sorted by node: exhaustive comparison of the sketches inside each node."""

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        def wide(name: str, kind: str) -> np.ndarray:
            joined = b"".join(batch.column(name).to_pylist())
            return np.frombuffer(joined, kind).reshape(batch.num_rows, -1)

        return [*(batch.column(c).to_numpy() for c in ("node", "cls", "n", "met", "tree")),
                wide("tokens", "<u4"), wide("sketch", "u1")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, found, held = [], [], 0

        def out() -> pa.RecordBatch:
            pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
            named = np.repeat(np.array(nodes, np.int64), [len(part) for part in found])
            return pa.RecordBatch.from_arrays([pa.array(named), pa.array(pairs[:, 0]), pa.array(pairs[:, 1])],
                                              names=["node", "cls", "leader"])

        for node, group in _groups(batches, columns):
            nodes.append(node)
            found.append(_Node(group, share).proposed())
            held += len(found[-1])
            if held >= 8192 or len(found) >= 8192:
                yield out()
                nodes, found, held = [], [], 0
        yield out()

    return run


def _link_nodes(size: int, threshold: int):
    """Over rows sorted by node: links, on full sets, that connect what is not connected yet."""

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        sets = np.empty(batch.num_rows, object)
        sets[:] = [shingle_set(text, size) for text in arrays.raw_texts(batch.column("_text"))]
        return [*(batch.column(c).to_numpy() for c in ("node", "cls", "root")), sets]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (ids, roots, sets) in _groups(batches, columns):
            links = connecting_links(sets, roots, threshold)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[links[:, 0]]), pa.array(ids[links[:, 1]])], names=["a", "b"])

    return run


def connecting_links(sets: np.ndarray, roots: np.ndarray, threshold: int) -> np.ndarray:
    """Pairs of similar sets that, with what ``roots`` connects, connect all that links do."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, group = np.unique(roots, return_inverse=True)
    largest = np.bincount(group).argmax()
    # Of two sets in different groups one is not in the largest.
    asked = np.flatnonzero(group != largest)
    if not len(asked):
        return np.zeros((0, 2), np.int64)
    # The sets that hold each shingle, for shingles of at least two.
    every, owner = np.concatenate(sets), np.repeat(np.arange(count), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.diff(every, prepend=every[0] ^ np.uint64(1)) != 0
    run = np.cumsum(new) - 1
    many = np.bincount(run)
    common = many[run] > 1
    run, owner = run[common], owner[common]
    _, run = np.unique(run, return_inverse=True)
    many = np.bincount(run, minlength=1)
    starts = np.cumsum(many) - many
    is_asked = group != largest
    shared = np.zeros((len(asked), count), np.float32)
    single = int(many[run[is_asked[owner]]].sum())
    if single * 10 < len(asked) * count * len(many) / 15:   # nanoseconds of either way
        by_owner = np.argsort(owner, kind="stable")
        bounds = np.searchsorted(owner[by_owner], np.arange(count + 1))
        for i, row in zip(asked, shared):
            mine = run[by_owner[bounds[i]:bounds[i + 1]]]
            at = np.repeat(starts[mine] - np.cumsum(many[mine]) + many[mine], many[mine])
            row += np.bincount(owner[at + np.arange(len(at))], minlength=count)
    else:
        for first in range(0, len(many), 2048):
            inside = (run >= first) & (run < first + 2048)
            holds = np.zeros((count, min(2048, len(many) - first)), np.float32)
            holds[owner[inside], run[inside] - first] = 1
            shared += holds[asked] @ holds.T
    found = []
    for i, row in zip(asked.tolist(), shared):
        linked = 100 * row.astype(np.int64) >= threshold * (sizes[i] + sizes - row.astype(np.int64))
        for j in np.flatnonzero(linked & (group != group[i])).tolist():
            if group[j] != group[i]:
                found.append((i, j))
                group[group == group[j]] = group[i]
    return np.array(found, np.int64).reshape(-1, 2)


def _confirm(size: int, threshold: int):
    """Keeps the pairs whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        held = 0

        def members(cls: int, text: pa.Scalar) -> np.ndarray:
            nonlocal held
            if cls not in known:
                if held > _HELD:
                    known.clear()
                    held = 0
                known[cls] = shingle_set(text.as_buffer().to_pybytes(), size)
                held += len(known[cls])
            return known[cls]

        for batch in batches:
            keep = []
            for a, b, left, right in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(),
                                         batch.column("text_a"), batch.column("text_b")):
                one, two = members(a, left), members(b, right)
                both = np.concatenate([one, two])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= threshold * (len(one) + len(two) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _token(k: Column) -> Column:
    """The k-th token of a sketch."""
    return F.substring("sketch", k + 1, F.lit(1))


def likely(rows: DataFrame, wanted: DataFrame, names: list[str]) -> DataFrame:
    """The rows whose ``names`` may be those of a wanted row: all that are, and as many others as
    share a bit with one. Only these texts need to be shuffled to a join that decides exactly."""
    place = F.pmod(F.xxhash64(*names), F.lit(MARKS)) + 1
    bucket, bit = F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_bit")
    marks = (wanted.select(bucket, bit).repartition("_bucket").groupBy("_bucket")
             .agg(F.bitmap_construct_agg("_bit").alias("_marks")))
    byte = "cast(conv(hex(substring(_marks, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    return (rows.select("*", bucket, bit).join(F.broadcast(marks), "_bucket")
            .where(F.expr(f"shiftright({byte}, cast(_bit % 8 as int)) & 1 = 1")).select(*rows.columns))


def _nodes(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Memberships in nodes of at least two classes: those to compare, those to branch."""
    sizes = members.groupBy("node").agg(
        F.count("*").alias("many"), F.sum("n").alias("shingles")).where("many > 1")
    told = members.join(splittable(sizes, ["node"]), "node").withColumn("parts", F.greatest(
        F.ceil(F.col("many") / NODE), F.ceil(F.col("shingles") / NODE_SHINGLES)).cast("int"))
    # Two sets are compared however large they are.
    fits = (F.col("parts") == 1) | (F.col("many") == 2)
    return told.where(fits).drop("many", "shingles"), told.where(~fits).drop("many", "shingles")


def _hang_on_leaders(large: DataFrame, card: DataFrame) -> DataFrame:
    """Members of large nodes that surely resemble the node's least class, with that class."""
    leaders = large.groupBy("node").agg(F.min("cls").alias("a"))
    sketch = card.select("cls", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH)
                        for c in ("one", "two"))
            near = (one == two).sum(axis=1) >= SURE
            yield batch.select(["a", "b"]).filter(pa.array(near))

    mine = sketch.select(F.col("cls").alias("b"), F.col("sketch").alias("two"))
    theirs = sketch.select(F.col("cls").alias("a"), F.col("sketch").alias("one"))
    pairs = large.join(leaders, "node").where("cls <> a").select("a", F.col("cls").alias("b")).distinct()
    return (pairs.join(mine, "b").join(theirs, "a").select("a", "b", "one", "two")
            .mapInArrow(run, "a long, b long"))


def _branch(large: DataFrame, depth: int) -> DataFrame:
    """Two children of each node, by tokens that the node itself chooses."""
    child = F.explode(F.array(F.lit(0), F.lit(1))).alias("child")
    chosen = F.pmod(F.xxhash64("node", F.lit(depth), "child"), F.lit(SKETCH)).cast("int")
    return (large.select("node", "cls", "n", "sketch", child)
            .select(F.xxhash64("node", "child", _token(chosen)).alias("node"), "cls", "n"))


def _blocks(large: DataFrame) -> DataFrame:
    """Nodes that no branching made small: one node for each two of their blocks."""
    mine = F.pmod(F.xxhash64("cls"), F.col("count")).cast("int")
    return (large.withColumn("count", 2 * F.col("parts")).withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
            .select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other"))
                    .alias("node"), "cls"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               shingle: int = SHINGLE, threshold: int = THRESHOLD, trees: int = TREES) -> DataFrame:
    """Groups of near-duplicate documents.

    Returns one row per row of ``df``: the id under its own name, ``n_shingles``,
    ``component_id`` (the least id reachable over links) and ``kept`` (the id is that least
    one), with ``_which`` (a hash of the text) last. Words are lower-cased in A-Z; a text of
    fewer words than a shingle is one shingle; a null or blank text has none and links with
    nothing. Rows without an id take part and can connect others; their ``component_id``
    is the least id of their group, or null if the group has none, and they are kept only then.
    Rows that repeat an id and a text are kept or go together. An empty table gives no rows.
    """
    spark = df.sparkSession
    steps = Steps(spark)
    written = steps.written
    rows = text_rows(df, id_col, text_col)
    described = written(describe(rows, shingle, trees), "sets")

    # One class per distinct set. It is named by its least id, or by its hash where an
    # id is absent or stands for several sets.
    sets = described.where("n > 0").groupBy("h1", "h2").agg(
        F.min("_id").alias("least"), F.min(F.struct(F.col("_id").isNull().alias("no"), "_id", "which"))
        .alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.first("tokens").alias("tokens"))
    firsts = sets.where("least is not null").groupBy("least").agg(
        F.min(F.struct("h1", "h2")).alias("owner"))
    classes = written(
        sets.join(firsts, "least", "left").withColumn(
            "cls", F.when((F.col("owner.h1") == F.col("h1")) & (F.col("owner.h2") == F.col("h2")),
                          F.col("least")).otherwise(F.col("h1")))
        .select("cls", "h1", "h2", "least", "n", "sketch", "tokens",
                F.col("rep._id").alias("rep_id"), F.col("rep.which").alias("rep_which")), "classes")

    def texts_of(wanted: DataFrame) -> DataFrame:
        """The texts that stand for the classes ``cls`` of a table."""
        reps = written(classes.select("cls", "rep_id", "rep_which").join(wanted.select("cls").distinct(), "cls"), "reps")
        texts = rows.withColumn("which", which_text())
        texts = likely(texts, reps.select(F.col("rep_id").alias("_id"), F.col("rep_which").alias("which")), ["_id", "which"])
        texts = texts.join(reps, texts["_id"].eqNullSafe(reps["rep_id"])
                           & (texts["which"] == reps["rep_which"])).select("cls", "_text")
        if repeats:
            texts = texts.groupBy("cls").agg(F.min("_text").alias("_text"))
        texts = written(texts, "texts")
        steps.remove(reps)
        return texts

    def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The pairs that are links."""
        right = texts.select(F.col("cls").alias("b"), F.col("_text").alias("text_b"))
        left = texts.select(F.col("cls").alias("a"), F.col("_text").alias("text_a"))
        joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        return written(joined.mapInArrow(_confirm(shingle, threshold), "a long, b long"), "links")

    # Rows that repeat both id and text would fetch a text twice.
    repeats = bool(described.where("n > 0").groupBy("_id", "which").count()
                             .where("count > 1").limit(1).count())

    members = classes.select("cls", "n", F.posexplode("tokens").alias("tree", "token")).select(
        F.xxhash64("tree", "token").alias("node"), "cls", "n", "tree")
    small, large = _nodes(members)
    small, large = written(small, "nodes"), written(large, "nodes")
    # What a node needs to know of a class; met: the trees whose first node compares it.
    short = F.expr("unhex(array_join(transform(tokens, t -> lpad(hex(t & 4294967295L), 8, '0')), ''))")
    met = small.groupBy("cls").agg(F.bit_or(F.expr("shiftleft(1L, tree)")).alias("met"))
    card = written(classes.select("cls", "n", "sketch", short.alias("tokens")).join(met, "cls", "left")
                   .withColumn("met", F.coalesce("met", F.lit(0).cast("long"))), "cards")
    roots = spark.createDataFrame([], "node long, root long")
    parts, depth = [small], 0

    def joined_by(links: DataFrame) -> DataFrame:
        """The components of these links and of all that were found before."""
        return components(links.unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    level = large
    while large.limit(1).count():
        pairs = written(_hang_on_leaders(large, card), "pairs")
        if pairs.limit(1).count():      # a node of one dense group is closed, not branched on
            wanted = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select(F.col("b").alias("cls")))
            texts = texts_of(wanted)
            links = confirmed(pairs, texts)
            steps.remove(texts)
            roots = joined_by(links)
            steps.remove(links)
            open_nodes = (large.join(roots, large["cls"] == roots["node"], "left")
                          .select(large["node"], F.coalesce("root", "cls").alias("root"))
                          .groupBy("node").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                          .where("lo <> hi").select("node"))
            large = large.join(open_nodes, "node", "left_semi")
        steps.remove(pairs)
        if depth == DEPTH:
            parts.append(written(_blocks(large), "nodes"))
            break
        less, large = _nodes(_branch(large.join(card.select("cls", "sketch"), "cls"), depth))
        parts.append(written(less, "nodes"))
        large = written(large, "nodes")
        steps.remove(level)
        level = large
        depth += 1
    # Level, not tree, for members of branched nodes: they come after every first node.
    members = parts[0].select("node", "cls", "tree")
    for part in parts[1:]:
        members = members.unionAll(part.select("node", "cls", F.lit(62).alias("tree")))

    proposed = written(
        members.join(card, "cls")
        .select("node", "cls", "n", "met", F.col("tree").cast("long").alias("tree"), "tokens", "sketch")
        .repartition("node").sortWithinPartitions("node")
        .mapInArrow(_compare_nodes(threshold / 100), "node long, cls long, leader long"), "proposed")
    steps.remove(*parts, card, level)
    texts = texts_of(proposed.select("cls").unionAll(proposed.select(F.col("leader").alias("cls"))))
    pairs = proposed.where("cls <> leader").select(
        F.least("cls", "leader").alias("a"), F.greatest("cls", "leader").alias("b")).distinct()
    links = confirmed(pairs, texts)
    roots = joined_by(links)
    steps.remove(links)

    rooted = proposed.select("node", "cls").join(roots.withColumnRenamed("node", "cls"), "cls", "left").select(
        "node", "cls", F.coalesce("root", "cls").alias("root"))
    open_nodes = (rooted.groupBy("node").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                  .where("lo <> hi").select("node"))
    links = written(
        rooted.join(open_nodes, "node", "left_semi").join(texts, "cls")
        .select("node", "cls", "root", "_text").repartition("node").sortWithinPartitions("node")
        .mapInArrow(_link_nodes(shingle, threshold), "a long, b long"), "links")
    steps.remove(texts, proposed)
    roots = joined_by(links)
    steps.remove(links)

    grouped = classes.join(roots, classes["cls"] == roots["node"], "left").select(
        "h1", "h2", "least", F.coalesce("root", "cls").alias("root"))
    names = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = grouped.join(names, "root").select("h1", "h2", "component_id")
    told = described.select("_id", "which", "n", "h1", "h2").join(
        named.withColumn("n", F.lit(1)).select("h1", "h2", "component_id"), ["h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id"))
    return told.select(
        F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"), F.col("which").alias("_which"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``df`` that ``near_dedup`` keeps, all columns as they are, and rows without an
    id whose group has none either."""
    told = near_dedup(df, id_col, text_col, **settings)
    wanted = told.where(F.col("kept") | F.col("component_id").isNull()).select(
        F.col(id_col).alias("_kept_id"), F.col("_which").alias("_kept_which")).distinct()
    packed = df.select(F.struct("*").alias("_row"), F.col(id_col).cast("long").alias("_id"),
                       F.col(text_col).cast("string").alias("_text"))
    packed = packed.select("_row", "_id", which_text().alias("which"))
    same = packed["_id"].eqNullSafe(wanted["_kept_id"]) & (packed["which"] == wanted["_kept_which"])
    return packed.join(wanted, same, "left_semi").select("_row.*")
