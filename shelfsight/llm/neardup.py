"""Near-duplicates: chosen-path set similarity join over shingles of words.

Documents with equal shingle sets are one class, and the smallest id stands for
it. The representatives go down trees: a tree puts together those that share the
minwise token of a coordinate; a node that is too large branches by further
coordinates, drawn by its path, and nodes small enough are compared
exhaustively. Independent trees repeat this until a pair at the threshold is
missed about once in ten million times.

What stays together at every level, such as a large group of copies, would
never get small. So links are looked for in rounds, and documents that links
join already are not compared again: the first round takes each document to the
most central of its neighbours in the node, the next ones the best neighbour of each
group. The last takes the documents that still have a neighbour in another
group (looked for only among those that had one in the round before), brings their texts to the nodes and compares full sets there; of what it
finds, a node returns only the links that join groups, never its pairs. All
links are confirmed on full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shelfsight.llm.graph import components, extended
from shelfsight.session import stage


@dataclass(frozen=True)
class ChosenPath:
    words: int = 5  # of a shingle
    percent: int = 75  # 100 * intersection / union, at least
    coordinates: int = 128  # minwise tokens of a document
    trees: int = 12
    branches: int = 2  # coordinates that a large node branches by
    depth: int = 6  # levels; what is still large then is compared in blocks
    leaf: int = 512  # documents that are compared exhaustively
    strangers: int = 2048  # documents outside the main component of a node with which its parts are compared exhaustively
    margin: float = 0.55  # agreement of the coordinates from which a pair is looked at: five deviations below the threshold
    block: int = 300_000  # shingles that are compared with one document at a time, about
    whole: int = 2_000_000  # shingles of the documents of a node that are compared on full sets at once, about

    def __post_init__(self):
        if not self.trees <= self.coordinates <= 255:
            raise ValueError("a tree needs a coordinate of its own, and matches are counted in a byte")


_ODD = np.uint64(0x9E3779B97F4A7C15)
# Documents of a group whose marks are all compared in one call: a few hundred kilobytes.
_SMALL = 96


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct shingles as sorted 64-bit hashes. Words: runs of other than ASCII white space, A-Z lower-cased."""
    own = (text or "").encode().lower().split()
    if not own:
        return np.empty(0, np.uint64)
    hashed = pd.util.hash_array(np.array(own, object), categorize=False)
    n = max(1, len(own) - words + 1)
    with np.errstate(over="ignore"):
        mixed = np.full(n, min(words, len(own)), np.uint64)
        for k in range(min(words, len(own))):
            mixed = ((mixed ^ (mixed >> np.uint64(29))) * _ODD) + hashed[k : k + n]
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _ODD
    return np.unique(mixed ^ (mixed >> np.uint64(29)))


def signature(found: np.ndarray, coordinates: int) -> np.ndarray:
    """Of each coordinate the minwise token, as 32 bits of its hash."""
    factors = np.random.default_rng(7).integers(0, 2**63, coordinates, np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(coordinates, 2**64 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(found), 2048):
            least = np.minimum(least, (found[at : at + 2048, None] * factors).min(0))
    return (least >> np.uint64(32)).astype(">u4")


def _sketches(docs: DataFrame, rules: ChosenPath) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, text in zip(frame["doc_id"], frame["text"]):
                found = shingles(text, rules.words)
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                rows.append((doc, len(found), digest, signature(found, rules.coordinates).tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "sketch"])

    # Ids travel as text: beside a null, pandas would make numbers of them that are not exact.
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    found = named.mapInPandas(run, "doc_id string, n_shingles long, digest binary, sketch binary")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _token(coordinate: Column) -> Column:
    return F.substring(F.col("sketch"), coordinate * 4 + 1, F.lit(4))


def _sized(rows: DataFrame, name: str) -> DataFrame:
    """(node, id, size) of the nodes with two documents or more."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return stage(rows.join(sizes, "node"), name)


def _groups(frames: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows sorted by ``key``, whatever batches they come in."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        values = frame[key].to_numpy()
        starts = np.flatnonzero(np.r_[True, (values[1:] != values[:-1]).any(1)]).tolist()
        for lo, hi in zip(starts, starts[1:]):
            yield frame.iloc[lo:hi]
        rest = frame.iloc[starts[-1] :].reset_index(drop=True)
    if rest is not None:
        yield rest


def _together(rows: DataFrame, *key: str) -> DataFrame:
    """Rows with the same key in one partition.

    Dealt by a hash of the key: a shuffle on the key itself is left out where a
    join has made it already, and the skew split of that join would then tear groups.
    The number of partitions is fixed: merging small ones goes by bytes, and the
    work of a group grows with the square of its rows.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(partitions, F.xxhash64(*key))


def _agreement(group: pd.DataFrame, rules: ChosenPath) -> np.ndarray:
    """Share of equal coordinates of any two documents of a group, 0 where sizes or coordinates rule a link out.

    Two ``shared`` documents meet in another part of the node, and have 0 here.
    Counted in bytes (there are no more than 255 coordinates) and for as many
    documents at a time as fit the processor's cache.
    """
    marks = np.frombuffer(b"".join(group["marks"]), np.uint8).reshape(len(group), -1)
    n = group["n_shingles"].to_numpy()
    own = np.flatnonzero(~group["shared"].to_numpy(bool))
    out = np.zeros((len(group), len(group)), np.float32)
    if len(group) <= _SMALL:  # most groups; one call for all coordinates
        out[own] = (marks[own, None] == marks).sum(2, dtype=np.uint8) / np.float32(marks.shape[1])
        own = own[:0]
    columns = np.ascontiguousarray(marks.T)
    height = max(1, (1 << 18) // len(group))
    for lo in range(0, len(own), height):
        some = own[lo : lo + height]
        equal = np.zeros((len(some), len(group)), np.uint8)
        same = np.empty(equal.shape, bool)
        for coordinate in columns:
            np.equal(coordinate[some, None], coordinate, out=same)
            np.add(equal, same.view(np.uint8), out=equal)
        out[some] = equal / np.float32(len(columns))
    out = np.maximum(out, out.T)
    near = np.minimum(n[:, None], n) * 100 >= np.maximum(n[:, None], n) * rules.percent
    out[(out < rules.margin) | ~near] = 0
    np.fill_diagonal(out, 0)
    return out


def _compared(rows: DataFrame, work: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """``work`` on each group (node, part) of ``rows``, which are bounded."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: list[tuple] = []
        names = [c.split()[0] for c in schema.split(", ")]
        for group in _groups(frames, ["node", "part"]):
            if len(group) > 1:
                found += work(group)
            if len(found) >= 10_000:
                yield pd.DataFrame(found, columns=names)
                found = []
        yield pd.DataFrame(found, columns=names)

    return _together(rows, "node", "part").sortWithinPartitions("node", "part", "id").mapInPandas(run, schema)


def _central(rules: ChosenPath) -> Callable[[pd.DataFrame], list[tuple]]:
    """Each document with the neighbour that is nearest to all others, and how near that is."""
    def work(group: pd.DataFrame) -> list[tuple]:
        agree = _agreement(group, rules)
        if not agree.any():
            return []
        centre, ids = agree.sum(0), group["id"].to_numpy()
        order = np.lexsort((ids, -centre))
        rank = np.empty(len(ids), int)
        rank[order] = np.arange(len(ids))
        node, out = int(group["node"].iloc[0]), []
        for k in np.flatnonzero(agree.any(1)).tolist():
            near = np.flatnonzero(agree[k])
            hub = near[rank[near].argmin()]
            lead = hub if rank[hub] < rank[k] else k
            out.append((node, int(ids[k]), int(ids[lead]), float(centre[lead])))
        return out

    return work


def _apart(group: pd.DataFrame, rules: ChosenPath) -> np.ndarray:
    """Agreement of documents of different components."""
    own = group["component"].to_numpy()
    agree = _agreement(group, rules)
    agree[own[:, None] == own] = 0
    return agree


_MEMBER = "node long, part long, id long, component long, shared boolean"


def _open(rules: ChosenPath) -> Callable[[pd.DataFrame], list[tuple]]:
    """The documents with a neighbour in another component.

    ``nearest`` is that neighbour for the document of each component that agrees
    most with one, and the document itself for the others.
    """
    def work(group: pd.DataFrame) -> list[tuple]:
        agree = _apart(group, rules)
        if not agree.any():
            return []
        own, ids = group["component"].to_numpy(), group["id"].to_numpy()
        order = np.argsort(-agree.max(1), kind="stable")
        first = order[np.unique(own[order], return_index=True)[1]]
        nearest = ids.copy()
        nearest[first] = ids[agree[first].argmax(1)]
        some = agree.any(1)
        rows = [group[c].to_numpy()[some].tolist() for c in ("node", "part", "id", "component", "shared")]
        return list(zip(*rows, nearest[some].tolist()))

    return work


def _forest(rules: ChosenPath) -> Callable[[pd.DataFrame], list[tuple]]:
    """Links on full sets that join the components of a group: fewer than it has components."""
    def work(group: pd.DataFrame) -> list[tuple]:
        sets = [shingles(text, rules.words) for text in group["text"]]
        group, sets = group[[len(found) > 0 for found in sets]], [found for found in sets if len(found)]
        if len(sets) < 2:
            return []
        sizes = np.array([len(found) for found in sets])
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        starts = np.r_[0, sizes.cumsum()]
        ids, label, out = group["id"].to_numpy(), group["component"].to_numpy().copy(), []
        seen = np.zeros(codes.max() + 1, np.int32)
        for k in np.flatnonzero(~group["shared"].to_numpy(bool)):
            if (label == label[k]).all():
                continue
            mine = codes[starts[k] : starts[k + 1]]
            seen[mine] = 1
            both = np.add.reduceat(seen[codes], starts[:-1])
            seen[mine] = 0
            linked = (100 * both >= rules.percent * (sizes + sizes[k] - both)) & (label != label[k])
            reached, first = np.unique(label[linked], return_index=True)
            out += [(int(min(ids[k], x)), int(max(ids[k], x))) for x in ids[linked][first]]
            label[np.isin(label, reached)] = label[k]
        return out

    return work


def _with_texts(members: DataFrame, texts: DataFrame, rules: ChosenPath) -> DataFrame:
    """Members with their texts; a part whose texts are long is dealt into blocks, and a group made of any two of them."""
    rows = members.join(texts.select("id", "n_shingles").distinct(), "id")
    blocks = rows.groupBy("node", "part").agg(F.ceil(2 * F.sum("n_shingles") / rules.whole).alias("blocks"))
    blocks = blocks.withColumn("blocks", F.when(F.col("blocks") > 2, F.col("blocks")).otherwise(1))
    dealt = members.join(blocks, ["node", "part"]).withColumn("mine", F.pmod(F.xxhash64("id"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    part = F.xxhash64("part", F.least("mine", "other"), F.greatest("mine", "other")).alias("part")
    return dealt.select("node", "id", "component", "shared", part).join(texts.select("id", "text"), "id")


def _confirmed(pairs: DataFrame, texts: DataFrame, rules: ChosenPath) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    The texts of all b of an a are dealt into blocks of bounded size, each with
    the text of a in front, and read one after the other.
    """
    sizes = texts.select(F.col("id").alias("b"), "n_shingles")
    dealt = stage(pairs.join(sizes, "b"), "candidates")
    blocks = dealt.groupBy("a").agg(F.ceil(F.sum("n_shingles") / rules.block).alias("blocks"))
    dealt = dealt.join(blocks, "a").select("a", "b", F.pmod(F.xxhash64("b"), "blocks").alias("part"))
    heads = blocks.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("part"))
    rows = heads.select("a", "part", F.col("a").alias("id"), F.lit(0).alias("turn")).unionByName(
        dealt.select("a", "part", F.col("b").alias("id"), F.lit(1).alias("turn"))
    )
    rows = rows.join(texts.select("id", "text"), "id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head = np.empty(0, np.uint64)
        for frame in frames:
            out = []
            for a, doc, turn, text in zip(frame["a"], frame["id"], frame["turn"], frame["text"]):
                found = shingles(text, rules.words)
                if not turn:
                    head = found
                    continue
                both = len(np.intersect1d(head, found, assume_unique=True))
                if 100 * both >= rules.percent * (len(head) + len(found) - both):
                    out.append((a, doc))
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return _together(rows, "a", "part").sortWithinPartitions("a", "part", "turn").mapInPandas(run, "a long, b long")


def _labelled(members: DataFrame, joined: DataFrame) -> DataFrame:
    """Members with their component, without the nodes that have but one."""
    own = members.join(joined.select(F.col("node").alias("id"), "component"), "id", "left")
    own = stage(own.withColumn("component", F.coalesce("component", "id")), "labelled")
    counts = own.groupBy("node", "component").agg(F.count("*").alias("n"))
    nodes = counts.groupBy("node").agg(
        F.count("*").alias("components"), F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("total")
    )
    nodes = nodes.where("components > 1").select(
        "node", F.col("top.component").alias("main"), F.col("top.n").alias("mains"), (F.col("total") - F.col("top.n")).alias("others")
    )
    return own.join(nodes, "node")


def _parts(members: DataFrame, leaf: int) -> DataFrame:
    """Members of nodes that can be compared whole, dealt into groups.

    The main component of a node is dealt into parts, the others are in every
    part, and from the second part on marked as ``shared``.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("mains") / leaf))
    own = F.when(F.col("component") == F.col("main"), F.array(F.pmod(F.xxhash64("id"), parts)))
    dealt = members.withColumn("part", F.explode(F.coalesce(own, F.sequence(F.lit(0).cast("long"), parts - 1))))
    shared = (F.col("component") != F.col("main")) & (F.col("part") > 0)
    return dealt.select("node", "id", "component", "part", shared.alias("shared"))


def _in_blocks(members: DataFrame, leaf: int) -> DataFrame:
    """Members of nodes that no branching makes small: blocks, and a group for any two of them."""
    blocks = F.ceil(2 * (F.col("mains") + F.col("others")) / leaf)
    dealt = members.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("id"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.select(
        "node", "id", "component", (F.least("mine", "other") * F.col("blocks") + F.greatest("mine", "other")).alias("part"),
        F.lit(False).alias("shared"),
    )


def near_duplicates(docs: DataFrame, rules: ChosenPath = ChosenPath()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Two documents are linked if ``100 * intersection >= percent * union`` of
    their sets of ``words``-word shingles; a text with fewer words has one
    shingle, all of it. ``component_id`` is the smallest doc_id reachable over
    links, ``kept`` marks the document that has it.

    A null or empty text, or one of white space, has no shingles and is linked
    with nothing. Rows with the same doc_id are one document, also if their
    texts differ: they share a component. A row without doc_id is in no
    component (null) and kept. Other columns are ignored; an empty
    table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    known = stage(_sketches(docs, rules), "sketches")
    usable = known.where("n_shingles > 0 and doc_id is not null")
    # One row per class, of which all documents have the same sketch; an id with several texts has several.
    alike = usable.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    marks = F.concat(*(F.substring("sketch", 4 * k + 4, 1) for k in range(rules.coordinates)))
    alike = stage(alike.withColumn("marks", marks), "classes")
    classes, sketches = alike.select("digest", "id"), alike.where("n_shingles > 1")

    roots = F.array(*(F.xxhash64(F.lit(t), _token(F.lit(t))) for t in range(rules.trees)))
    level = _sized(sketches.select("id", F.explode(roots).alias("node")), "tree-0")

    looks = sketches.select("id", "n_shingles", "marks")
    # First round: each document to the most central of its neighbours, and large nodes to one centre.
    large = F.col("size") > rules.leaf
    dealt = level.withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / rules.leaf)))
    central = stage(
        _compared(
            dealt.select("node", "id", "part", F.lit(False).alias("shared")).join(looks, "id"),
            _central(rules), "node long, id long, hub long, score double",
        ),
        "central",
    )
    sides = central.where("id <> hub")
    stars = sides.groupBy("id").agg(F.max(F.struct("score", -F.col("hub"))).alias("best")).select(
        (-F.col("best.`col2`")).alias("a"), F.col("id").alias("b")
    )
    crowds = level.where(large)
    tops = central.join(crowds.select("node").distinct(), "node").groupBy("node", "hub").agg(F.max("score").alias("score"))
    middle = tops.groupBy("node").agg(F.max(F.struct("score", "hub")).alias("top"))
    bridges = tops.join(middle, "node").select(F.col("top.hub").alias("a"), F.col("hub").alias("b")).where("a <> b")
    candidates = stars.unionByName(bridges).distinct()

    # Texts that can be in a link at all: those with a near neighbour, and all of large nodes.
    suspects = central.select("id").union(central.select("hub")).union(crowds.select("id")).distinct()
    whole = docs.join(suspects.withColumnRenamed("id", "doc_id"), "doc_id")
    named = known.select("doc_id", "n_shingles").where("n_shingles > 0").groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    texts = stage(whole.join(named, "doc_id").select(F.col("doc_id").alias("id"), "n_shingles", "text"), "suspects")

    links = _confirmed(candidates, texts, rules)
    mark = F.xxhash64("digest")
    twofold = usable.groupBy("doc_id").agg(F.min(mark).alias("lo"), F.max(mark).alias("hi")).where("lo <> hi")
    twofold = usable.select("doc_id", "digest").join(twofold, "doc_id").join(classes, "digest")
    links = stage(links.unionByName(twofold.select(F.col("doc_id").alias("a"), F.col("id").alias("b"))), "links-0")
    joined = components(links)

    # Down the trees: nodes of several components, until they can be compared.
    ready, depth = [], 0
    while True:
        open_ = _labelled(level, joined)
        small = F.col("others") <= rules.strangers
        ready.append(stage(_parts(open_.where(small), rules.leaf), "leaves"))
        rest = open_.where(~small)
        depth += 1
        if rest.isEmpty():
            break
        if depth == rules.depth:
            ready.append(stage(_in_blocks(rest, rules.leaf), "blocks"))
            break
        chosen = F.array(*(F.pmod(F.xxhash64("node", F.lit(k)), F.lit(rules.coordinates)).cast("int") for k in range(rules.branches)))
        children = rest.select("id", "node", F.explode(F.array_distinct(chosen)).alias("coordinate")).join(
            sketches.select("id", "sketch"), "id"
        )
        level = _sized(children.select("id", F.xxhash64("node", "coordinate", _token(F.col("coordinate"))).alias("node")), f"tree-{depth}")
    members = ready[0]
    for more in ready[1:]:
        members = members.unionByName(more)

    def several(rows: DataFrame) -> DataFrame:
        """Rows of the groups that still have more than one component."""
        fresh = rows.drop("component").join(joined.select(F.col("node").alias("id"), "component"), "id", "left")
        fresh = fresh.withColumn("component", F.coalesce("component", "id"))
        mixed = fresh.groupBy("node", "part").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        return fresh.join(mixed.select("node", "part"), ["node", "part"])

    def neighbours(rows: DataFrame, name: str) -> DataFrame:
        return stage(_compared(several(rows).join(looks, "id"), _open(rules), f"{_MEMBER}, nearest long"), name)

    # Groups only grow together, so who has no neighbour in another one now will have none later.
    found = neighbours(members, "neighbours")
    pairs = found.where("id <> nearest").select(F.least("id", "nearest").alias("a"), F.greatest("id", "nearest").alias("b"))
    joined = extended(joined, stage(_confirmed(pairs.distinct(), texts, rules), "links-1"))
    row = [c.split()[0] for c in _MEMBER.split(", ")]
    still = neighbours(found.select(row).distinct(), "open").select(row).distinct()
    joined = extended(joined, stage(_compared(_with_texts(stage(still, "still"), texts, rules), _forest(rules), "a long, b long"), "links-2"))

    labels = joined.select(F.col("node").alias("id"), "component")
    classes = stage(classes.join(labels, "id", "left").select("digest", F.coalesce("component", "id").alias("found")), "labels")
    out = known.join(classes, "digest", "left")
    own = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("found", "doc_id")).otherwise(F.col("doc_id"))
    kept = F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
    return out.select("doc_id", "n_shingles", own.alias("component_id")).withColumn("kept", kept)
