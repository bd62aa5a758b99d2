"""Exact Jaccard join of word shingle sets by grouped prefixes.

Two texts link when their sets of distinct shingles have a Jaccard similarity
of at least 80 in 100. The prefix of a set is its rarest n - ceil(0.8 n) + 1
shingles in one order of all shingles (by how many sets hold them); linked sets
share a shingle of their prefixes. So:

1. Equal sets are one node. A set whose prefix has a shingle that no other set
   holds for every place links with nothing and leaves at once.
2. Nodes with the same prefix and size form a group; groups, not nodes, are
   posted under the prefix shingles, and pairs of groups are filtered by size,
   by the position of the shared shingle and, for groups of one, by bitmaps.
3. Pairs are expanded to members and verified on the full sets.

Only components are wanted, so verification goes in rounds: first each group
against its centre and each posting's groups against the posting's centre, then
LEADS times those of other components against the centre of the posting's
leading component, which are as many pairs as postings; after that all members
of groups whose components still differ. Every pair that shares a prefix shingle is thus
verified or already connected: a large group of near copies costs its size,
not its square, and no link between components is lost.

Shingles are 64-bit hashes, sets are named by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from celloom.llm.common import WORD, arrow_schema, batch, landed, utf8
from celloom.llm.components import components
from celloom.llm.hashing import LOWERED, SPACES, as_bytes, shingle_set, word_hashes

WIDTH = 5
PERCENT = 80
#: A shingle in at least one of so many documents is common: it is ordered last and not posted.
COMMON_SHARE = 512
#: Shingles gathered before a task writes its postings, and wanted in a bucket.
FLUSH = 1 << 21
#: Fewest buckets, so that a set's shingles are spread alike over small and large inputs.
BUCKETS = 64
#: Rounds in which postings are compared with the centre of their leading component.
LEADS = 1
#: Longs of a set's parity bitmap.
PARITY = 8

_SETS = "doc_id long, row long, n long, node binary, shingle long, seen long"
_POSTS = "bucket int, node binary, n long, blob binary"
_SHARED = "node binary, n long, tokens binary, counts binary, shared long"
_NODES = "node binary, n long, alone long, tokens binary, prefix array<long>, grp binary, bits array<long>"
_PAIR = "a binary, b binary"


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Places of the prefix of a set of n."""
    return n - (n * percent + 99) // 100 + 1


def _named(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _longs(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def _sets(width: int):
    """Each document's set name and size; shingles that are common among a task's documents."""
    schema = arrow_schema(_SETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = [], 0, 0

        def common() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(4, docs // COMMON_SHARE)
            values, counts = values[often], counts[often]
            none = [None] * len(values)
            return batch(schema, doc_id=none, row=none, n=none, node=none, shingle=_longs(values), seen=counts)

        for b in batches:
            names, sizes = [], []
            for hashes in word_hashes(as_bytes(b.column("bytes")), SPACES, LOWERED):
                shingles = shingle_set(hashes, width)
                names.append(_named(shingles))
                sizes.append(len(shingles))
                held.append(shingles)
                docs, size = docs + 1, size + len(shingles)
                if size >= FLUSH:
                    yield common()
                    held, docs, size = [], 0, 0
            none = [None] * len(names)
            yield batch(schema, doc_id=b.column("doc_id"), row=b.column("row"), n=sizes, node=names, shingle=none, seen=none)
        if held:
            yield common()

    return run


def _member(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values


def _posts(width: int, buckets: int, common):
    """Shingles by bucket, packed: names, counts and shingles of the sets, equal sets once a flush.

    Buckets below 0 hold each set's size and its common shingles, which are not posted.
    """
    schema = arrow_schema(_POSTS)

    def pack(names: list[bytes], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        often = common.value
        if not names:
            return
        split = [_member(often, s) for s in sets]
        yield batch(
            schema,
            bucket=[-1 - int.from_bytes(name[:4], "little") % buckets for name in names],
            node=names,
            n=[len(s) for s in sets],
            blob=[s[c].tobytes() for s, c in zip(sets, split)],
        )
        sets = [s[~c] for s, c in zip(sets, split)]
        tokens = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
        # the sets are sorted, so a bucket is a stretch of each of them
        place = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(place, kind="stable")
        tokens, owner, place = tokens[order], owner[order], place[order]
        cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True]) if len(place) else np.zeros(1, int)
        keys, blobs = [], []
        all_names = np.frombuffer(b"".join(names), np.uint8).reshape(-1, 16)
        for start, end in zip(cuts[:-1], cuts[1:]):
            own, counts = np.unique(owner[start:end], return_counts=True)
            keys.append(int(place[start]))
            blobs.append(
                np.uint32(len(own)).tobytes() + all_names[own].tobytes() + counts.astype(np.uint32).tobytes() + tokens[start:end].tobytes()
            )
        none = [None] * len(keys)
        yield batch(schema, bucket=keys, node=none, n=none, blob=blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        size = 0
        for b in batches:
            for hashes in word_hashes(as_bytes(b.column("bytes")), SPACES, LOWERED):
                shingles = shingle_set(hashes, width)
                if len(shingles) and (name := _named(shingles)) not in held:
                    held[name] = shingles
                    size += len(shingles)
                if size >= FLUSH:
                    yield from pack(list(held), list(held.values()))
                    held, size = {}, 0
        yield from pack(list(held), list(held.values()))

    return run


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    k = int(np.frombuffer(blob, np.uint32, 1)[0])
    names = np.frombuffer(blob, "V16", k, 4)
    counts = np.frombuffer(blob, np.uint32, k, 4 + 16 * k)
    return names, counts, np.frombuffer(blob, np.uint64, offset=4 + 20 * k)


def _share(table: pa.Table) -> pa.Table:
    """Of a bucket, the shingles that two sets hold at least, with how many hold them, by set.

    Rows of the buckets below 0 pass, once for each set.
    """
    schema = arrow_schema(_SHARED)
    if table.column("bucket")[0].as_py() < 0:
        rows = {r["node"]: r for r in table.to_pylist()}.values()
        return pa.Table.from_batches(
            [
                batch(
                    schema,
                    node=[r["node"] for r in rows],
                    n=[r["n"] for r in rows],
                    tokens=[r["blob"] for r in rows],
                    counts=[b""] * len(rows),
                    shared=[0] * len(rows),
                )
            ]
        )
    parts = [_unpack(b) for b in table.column("blob").to_pylist()]
    names, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    owner = np.repeat(inverse.astype(np.uint32), np.concatenate([p[1] for p in parts]))
    tokens = np.concatenate([p[2] for p in parts])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    twice = np.zeros(len(tokens), bool)
    same = tokens[1:] == tokens[:-1]
    twice[1:] |= same
    twice[:-1] |= same
    tokens, owner = tokens[twice], owner[twice]
    # the same set from two tasks counts once
    order = np.lexsort((owner, tokens))
    tokens, owner = tokens[order], owner[order]
    first = np.ones(len(tokens), bool)
    first[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[first], owner[first]
    start = np.ones(len(tokens), bool)
    start[1:] = tokens[1:] != tokens[:-1]
    run = np.cumsum(start) - 1
    counts = np.bincount(run)[run].astype(np.uint32) if len(run) else np.zeros(0, np.uint32)
    keep = counts > 1
    tokens, owner, counts = tokens[keep], owner[keep], counts[keep]
    order = np.argsort(owner, kind="stable")
    tokens, owner, counts = tokens[order], owner[order], counts[order]
    cuts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.zeros(1, int)
    pieces = list(zip(cuts[:-1], cuts[1:]))
    return pa.Table.from_batches(
        [
            batch(
                schema,
                node=[names[owner[s]].tobytes() for s, _ in pieces],
                n=[None] * len(pieces),
                tokens=[tokens[s:e].tobytes() for s, e in pieces],
                counts=[counts[s:e].tobytes() for s, e in pieces],
                shared=[int(e - s) for s, e in pieces],
            )
        ]
    )


def _parity(tokens: np.ndarray) -> np.ndarray:
    """For each of 512 hash values, whether an odd number of the tokens has it."""
    odd = np.bincount((tokens >> np.uint64(55)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(common, common_counts, percent: int):
    """Nodes whose prefix has a shared shingle, with all their shared shingles and their group."""
    schema = arrow_schema(_NODES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, how_often = common.value, common_counts.value
        for b in batches:
            rows = {name: [] for name in schema.names}
            for row in b.to_pylist():
                rare = np.frombuffer(b"".join(p["tokens"] for p in row["parts"]), np.uint64)
                counts = np.frombuffer(b"".join(p["counts"] for p in row["parts"]), np.uint32).astype(np.int64)
                hot = np.frombuffer(row["hot"], np.uint64)
                n = row["n"]
                alone = n - len(rare) - len(hot)
                places = prefix_length(n, percent) - alone
                if places <= 0:
                    continue
                tokens = np.concatenate([rare, hot])
                hot_counts = how_often[np.searchsorted(often, hot)] if len(hot) else np.zeros(0, np.int64)
                common_last = np.r_[np.zeros(len(rare), np.int8), np.ones(len(hot), np.int8)]
                order = np.lexsort((tokens, np.concatenate([counts, hot_counts]), common_last))
                prefix = tokens[order[:places]]
                rows["node"].append(row["node"])
                rows["n"].append(n)
                rows["alone"].append(alone)
                rows["tokens"].append(np.sort(tokens).tobytes())
                rows["prefix"].append(_longs(prefix))
                rows["bits"].append(_parity(tokens))
                rows["grp"].append(hashlib.blake2b(n.to_bytes(8, "little") + prefix.tobytes(), digest_size=16).digest())
            yield batch(schema, **rows)

    return run


def _linked(percent: int):
    """Pairs whose sets are similar enough."""
    schema = arrow_schema(_PAIR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            columns = [b.column(c).to_pylist() for c in ("tokens_a", "tokens_b", "n_a", "n_b")]
            for x, y, n, m in zip(*columns):
                both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                ok.append(100 * both >= percent * (n + m - both))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_())).cast(schema)

    return run


def _verified(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    sets = nodes.select("node", "n", "tokens")
    a = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("tokens_a"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("tokens_b"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(_linked(percent), _PAIR)


def _comparable(n: str, m: str, percent: int) -> str:
    return f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})"


def _near_enough(n: str, at: str, m: str, bt: str, percent: int) -> str:
    """Whether sets whose first shared prefix shingle stands at these places can share enough."""
    return f"least({n} - {at}, {m} - {bt}) * {100 + percent} >= {percent} * ({n} + {m})"


def _bits_allow(x: str, y: str, percent: int) -> str:
    """Whether two sets' parity bitmaps allow enough common shingles; a group without one bitmap does.

    Each place where they differ is a shingle that one of them lacks, so
    common <= (shared_x + shared_y - places) / 2.
    """
    places = " + ".join(f"bit_count({x}.bits[{k}] ^ {y}.bits[{k}])" for k in range(PARITY))
    return (
        f"({x}.bits is null OR {y}.bits is null OR "
        f"({x}.n - {x}.alone + {y}.n - {y}.alone - ({places})) * {100 + percent} >= {2 * percent} * ({x}.n + {y}.n))"
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def _centre_pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Members with their group's centre, and groups' centres with the centre of each posting."""
    groups = nodes.groupBy("grp").agg(
        F.min(F.struct("alone", "node")).alias("c"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("alone").alias("alone")
    )
    inside = nodes.select("grp", "node").join(groups.select("grp", F.col("c.node").alias("a")), "grp").select("a", F.col("node").alias("b"))
    posts = groups.select(F.col("c.node").alias("node"), "alone", "n", F.posexplode("prefix").alias("pos", "shingle"))
    centre = posts.groupBy("shingle").agg(F.min(F.struct("alone", "node", "n")).alias("c"), F.count("*").alias("k")).where("k > 1")
    across = (
        posts.join(centre.select("shingle", "c"), "shingle")
        .where(_comparable("n", "c.n", percent))
        .select(F.col("c.node").alias("a"), F.col("node").alias("b"))
    )
    return _ordered(inside.union(across))


def _members(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Nodes with their component so far, and their part: the members of a group in one component."""
    rooted = nodes.select("node", "n", "alone", "prefix", "grp", "bits").join(
        roots.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left"
    )
    part = F.unhex(F.sha2(F.concat("grp", "root"), 256))
    return landed(rooted.withColumn("root", F.coalesce("root", "node")).withColumn("part", part), "members")


def _mixed_posts(members: DataFrame) -> DataFrame:
    """Parts under the prefix shingles that have parts of several components."""
    parts = members.groupBy("part").agg(
        *[F.first(c).alias(c) for c in ("root", "n", "alone", "prefix")],
        F.min("node").alias("node"),
        F.when(F.count("*") == 1, F.first("bits")).alias("bits"),
    )
    posts = parts.select("part", "node", "root", "n", "alone", "bits", F.posexplode("prefix").alias("pos", "shingle"))
    posts = posts.withColumn("pos", F.col("pos") + F.col("alone"))
    mixed = posts.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("shingle")
    return landed(posts.join(mixed, "shingle", "left_semi"), "postings")


def _leading_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """Of each posting, the centre of the component with most parts in it, with the parts of the others."""
    by_root = posts.groupBy("shingle", "root").agg(F.count("*").alias("k"), F.min(F.struct("alone", "node", "n")).alias("c"))
    lead = by_root.groupBy("shingle").agg(F.max(F.struct("k", "root", "c")).alias("lead"))
    return _ordered(
        posts.join(lead, "shingle")
        .where("root <> lead.root")
        .where(_comparable("n", "lead.c.n", percent))
        .select(F.col("lead.c.node").alias("a"), F.col("node").alias("b"))
    )


def _open_pairs(members: DataFrame, posts: DataFrame, percent: int) -> DataFrame:
    """Member pairs of groups that share a prefix shingle and are not yet in one component."""
    x, y = posts.alias("x"), posts.alias("y")
    alike = (
        _comparable("x.n", "y.n", percent),
        _near_enough("x.n", "x.pos", "y.n", "y.pos", percent),
        _bits_allow("x", "y", percent),
    )
    parts = (
        x.join(y, F.expr(" AND ".join(("x.shingle = y.shingle", "x.root < y.root", *alike))))
        .select(F.col("x.part").alias("p"), F.col("y.part").alias("q"))
        .distinct()
    )
    left = members.select(F.col("part").alias("p"), F.col("node").alias("a"))
    right = members.select(F.col("part").alias("q"), F.col("node").alias("b"))
    return _ordered(parts.join(left, "p").join(right, "q").select("a", "b"))


def _rooted(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, row, n, root): every row's text hash, set size and component."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), utf8().alias("bytes"))
    sets = landed(rows.mapInArrow(_sets(width), _SETS), "sets")
    named = sets.where("node is not null").select("doc_id", "row", "n", "node")
    total, count = named.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # at most COMMON_SHARE times a set's mean size
    often = (
        sets.where("shingle is not null").groupBy("shingle").agg(F.sum("seen").alias("seen")).where(F.col("seen") >= max(16, count // COMMON_SHARE)).collect()
    )
    often = sorted((r.shingle % (1 << 64), r.seen) for r in often)
    common = spark.sparkContext.broadcast(np.array([t for t, _ in often], np.uint64))
    common_counts = spark.sparkContext.broadcast(np.array([c for _, c in often], np.int64))

    buckets = max(BUCKETS, -(-total // FLUSH))
    posts = rows.select("bytes").mapInArrow(_posts(width, buckets, common), _POSTS)
    shared = posts.groupBy("bucket").applyInArrow(_share, _SHARED)
    parts = F.collect_list(F.when(F.col("n").isNull(), F.struct("tokens", "counts")))
    gathered = (
        shared.groupBy("node")
        .agg(
            F.max("n").alias("n"),
            F.max(F.when(F.col("n").isNotNull(), F.col("tokens"))).alias("hot"),
            F.sum("shared").alias("shared"),
            parts.alias("parts"),
        )
        .where(f"n - shared - octet_length(hot) div 8 < n - (n * {percent} + 99) div 100 + 1")
    )
    nodes = landed(gathered.mapInArrow(_prefixes(common, common_counts, percent), _NODES), "nodes")

    roots = components(_verified(_centre_pairs(nodes, percent), nodes, percent))
    for _ in range(LEADS):
        posts = _mixed_posts(_members(nodes, roots))
        roots = components(roots.union(_verified(_leading_pairs(posts, percent), nodes, percent)))
    members = _members(nodes, roots)
    roots = components(roots.union(_verified(_open_pairs(members, _mixed_posts(members), percent), nodes, percent)))

    roots = roots.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return named.join(roots, "node", "left").select("doc_id", "row", "n", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs` (doc_id, text).

    component_id is the smallest doc_id that links reach. Words are lower-cased
    in A-Z. A text of fewer words than the width is one shingle; a null text or
    one without words has no shingle and links with nothing. Repeated rows are
    returned each. A null doc_id takes part, its component is named by the
    others' smallest id, null if there is none. Other columns are ignored.
    """
    rooted = _rooted(docs, width, percent)
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("least"))
    return rooted.join(least, "root").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )


def kept_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs`, with their columns, one for each component: of its smallest doc_id, once.

    Texts without words link with nothing and all stay, repeated rows of them too.
    """
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row")).alias("one")
    heads = _rooted(docs, width, percent).where("n > 0").groupBy("root").agg(one)
    # names that the caller's columns have not
    free = "_"
    while any(c.lower().startswith(f"{free}kept") for c in docs.columns):
        free += "_"
    head, row, nth = (f"{free}kept_{part}" for part in ("head", "row", "nth"))
    heads = heads.select(F.col("one.doc_id").alias(head), F.col("one.row").alias(row))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    words = F.coalesce(F.col("text"), F.lit("")).rlike(WORD)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(head)) & (F.xxhash64("text") == F.col(row))
    first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("text")
    once = docs.where(words).join(heads, same, "left_semi").withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1)
    return once.select(*columns).union(docs.where(~words).select(*columns))
