"""Exact n-gram Jaccard self join by a token-group matrix.

Documents with equal shingle sets are one class. Shingles are ordered, frequent ones last; of a set of size n, the first
n - need + slack shingles are its prefix (need: the least overlap of a link, slack: SLACK of n), and linked sets share at least
the smaller slack of prefix shingles. Then:

1. Prefix shingles that several classes hold are found by one exchange of (shingle, class). Classes with too few of them link
   with nothing.
2. Groups of similar documents: a class's group is its most widely shared prefix shingle, split into parts of about CHUNK.
3. Each group's classes are first compared with its hub, the class with most shared shingles; what links is one component
   already, so families of near copies need no comparison of all their pairs.
4. Token-group matrix: the distinct (shingle, group) rows are each group's token union. Shingles that one component alone holds
   are left out, since a link that is still missing joins two. A class's overlap with a group's union is counted by a join; only
   groups that reach the bound, and hold a component larger than the class's own, are opened.
5. Opened groups count the overlap of the query with all their members through an inverted index of the whole sets, and give
   every link that joins components. Groups with many queries are salted.
6. Connected components of the links.

Nothing is capped or sampled: the frequent shingles (a bounded list) only decide the order, and any order is exact. A class is
named by a 64-bit hash of its set and checked by a second one: where sets share a name, it is replaced by the second hash.

Defined results: null or empty text, or blanks alone, has no shingle and is its own component. A text of fewer words than the
shingle has its whole sequence as one shingle. Equal doc_ids count as one node for component ids; each row stays. Null doc_id
rows stay, linked as their text links, and never name a component unless no other row can. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curio.llm.common import byte_column, docs_of, map_arrow, materialise
from curio.llm.components import connected
from curio.llm.shingles import _mix, shingle_sets

SLACK = 0.05
CHUNK = 512
FREQUENT = 200_000  # most frequent shingles that are known by name
FREQUENT_LEAST = 8  # occurrences in COUNTED shingles to be counted at all
COUNTED = 4_000_000
QUERIES = 2048  # of a group in one task
KNOWN = 2_000_000  # classes whose ids are broadcast to thin out step 3's exchange; beyond, all go
MOST_TAKEN = 10_000  # names that several sets share; more raise an error
TEXT_BYTES = 4 << 20  # of texts worked on at a time


def _parts(b: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts = b.column(0).to_pylist(), byte_column(b.column(1))
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > TEXT_BYTES:
            yield ids[lo:i], texts[lo:i]
            lo, size = i, 0
        size += len(t)
    yield ids[lo:], texts[lo:]


def class_ids(h: np.ndarray, st: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit ids of sorted sets: equal sets, equal ids; empty sets 0."""
    n = np.diff(st)
    full = np.flatnonzero(n)
    out = np.zeros((2, len(n)), np.uint64)
    for own, seed in zip(out, (0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47), strict=True):
        if len(full):
            own[full] = _mix(np.add.reduceat(_mix(h ^ np.uint64(seed)), st[:-1][full]) ^ (n[full].astype(np.uint64) << np.uint64(40)))
    return out[0].view(np.int64), out[1].view(np.int64)


def frequent(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes of the most frequent shingles over all documents."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def send() -> pa.RecordBatch:
            u, c = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            k = c >= FREQUENT_LEAST
            return pa.RecordBatch.from_arrays([pa.array(u[k].view(np.int64)), pa.array(c[k].astype(np.int64))], schema=schema)

        for b in batches:
            for _, texts in _parts(b):
                h, _ = shingle_sets(texts, width)
                held.append(h)
                size += len(h)
                if size >= COUNTED:
                    yield send()
                    held, size = [], 0
        yield send()

    sums = map_arrow(docs, run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    top = sums.orderBy(F.desc("n"), "token").limit(FREQUENT).select("token").collect()
    return np.sort(np.array([r.token for r in top], np.int64).view(np.uint64))


def need(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / F.lit(100))


def _sets(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, class, and the prefix of each class where a task sees it first; names that several sets had, now replaced)."""
    common = docs.sparkSession.sparkContext.broadcast(frequent(docs, width))

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        late, seen = common.value, set()
        for b in batches:
            for ids, texts in _parts(b):
                h, st = shingle_sets(texts, width)
                (cls, check), n = class_ids(h, st), np.diff(st)
                if len(late):
                    at = np.minimum(np.searchsorted(late, h), len(late) - 1)
                    hot = late[at] == h
                    order = np.lexsort((h, hot, np.repeat(np.arange(len(n)), n)))
                    h = h[order]
                size = np.minimum(n, n - (-(-n * percent // 100)) + np.ceil(n * SLACK).astype(np.int64))
                prefix = []
                for i, c in enumerate(zip(cls.tolist(), check.tolist(), strict=True)):
                    if not n[i] or c in seen:
                        prefix.append(None)
                    else:
                        seen.add(c)
                        prefix.append(h[st[i] : st[i] + size[i]].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n), pa.array(cls), pa.array(check), pa.array(prefix, schema.field(4).type)], schema=schema)

    sets = materialise(map_arrow(docs, run, "doc_id bigint, n bigint, class bigint, check bigint, prefix array<bigint>"), "jaccard-sets")
    names = sets.where("n > 0").groupBy("class").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo < hi").select("class")
    taken = np.sort(np.array([r["class"] for r in names.limit(MOST_TAKEN + 1).collect()], np.int64))
    if len(taken) > MOST_TAKEN:  # about the square of the number of classes over 2**65 are expected
        raise RuntimeError("too many sets share a 64-bit name")
    if len(taken):
        sets = sets.withColumn("class", F.when(F.col("class").isin(taken.tolist()), F.col("check")).otherwise(F.col("class")))
    return sets.drop("check"), taken


def _shared(sets: DataFrame) -> DataFrame:
    """(token, class, n) of the tokens that several classes hold."""

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        t0, c0, n0, sent = None, None, None, False  # the last row, and whether its token is known to be shared
        for b in batches:
            t, c, n = (x.to_numpy(zero_copy_only=False) for x in b.columns)
            if t0 is not None:
                t, c, n = np.concatenate([[t0], t]), np.concatenate([[c0], c]), np.concatenate([[n0], n])
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
            t, c, n = t[new], c[new], n[new]
            like = t[1:] == t[:-1]
            many = np.zeros(len(t), bool)
            many[1:] |= like
            many[:-1] |= like
            if sent:
                many[0] = False  # it has gone out with its batch
            last_sent = bool(many[-1]) or (sent and len(t) == 1)
            yield pa.RecordBatch.from_arrays([pa.array(t[many]), pa.array(c[many]), pa.array(n[many])], schema=schema)
            t0, c0, n0, sent = t[-1], c[-1], n[-1], last_sent

    rows = sets.where(F.col("prefix").isNotNull()).select(F.explode("prefix").alias("token"), "class", "n")
    return map_arrow(rows.repartition("token").sortWithinPartitions("token", "class"), run, "token bigint, class bigint, n bigint")


def _least(n: Column, percent: int) -> Column:
    """The least number of prefix tokens that a set of n shares with any partner."""
    return F.greatest(F.lit(1), F.ceil(need(n, percent) * F.lit(SLACK)))


def links(docs: DataFrame, width: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(sets: doc_id, n, class; edges: u, v between classes, enough of them to connect every two that link)."""
    d = docs_of(docs)
    sets, taken = _sets(d, width, percent)
    shared = materialise(_shared(sets), "jaccard-shared")
    busy = shared.groupBy("class").agg(F.count("*").alias("tokens"), F.first("n").alias("n")).where(F.col("tokens") >= _least(F.col("n"), percent))
    shared = materialise(shared.join(busy.select("class", "tokens"), "class"), "jaccard-matrix")

    # Aggregates that hot keys are joined to are written first: both sides of the join are then exchanged, and can be split.
    held = materialise(shared.groupBy("token").agg(F.count("*").alias("m")), "jaccard-held")
    home = shared.join(held, "token").groupBy("class").agg(F.max(F.struct("m", "token")).alias("best"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    home = home.select("class", "n", "tokens", F.col("best.token").alias("home"))
    home = materialise(home, "jaccard-homes")
    stats = materialise(home.groupBy("home").agg(F.count("*").alias("members"), F.max(F.struct("tokens", "class", "n")).alias("hub")), "jaccard-stats")
    placed = home.join(stats, "home").select("class", "n", "home", "members", F.col("hub.class").alias("hub"), F.col("hub.n").alias("hub_n"), F.xxhash64("home", F.pmod(F.xxhash64("class"), F.ceil(F.col("members") / CHUNK))).alias("gid"))
    placed = materialise(placed, "jaccard-groups")

    texts = materialise(_texts(d, placed, width, taken), "jaccard-texts")  # class, blob
    # Only sets of like sizes can link, so what a hub adds to a row is no longer than the row's own text by much.
    alike = (F.col("n") * 100 >= F.col("hub_n") * percent) & (F.col("hub_n") * 100 >= F.col("n") * percent)
    with_hub = placed.where("members > 1 AND class <> hub").where(alike).select("class", "hub").join(texts, "class")
    hubs = placed.where("class = hub").select(F.col("class").alias("hub")).join(texts.select(F.col("class").alias("hub"), F.col("blob").alias("hub_blob")), "hub")
    near = materialise(map_arrow(with_hub.join(hubs, "hub").select("class", "blob", "hub", "hub_blob"), _compare(width, percent), "u bigint, v bigint"), "jaccard-hubs")

    comp = placed.join(near.select(F.col("u").alias("class"), F.col("v").alias("linked")), "class", "left").withColumn("comp", F.coalesce("linked", "class"))
    comp = materialise(comp.select("class", "n", "gid", "comp"), "jaccard-components")
    sizes = materialise(comp.groupBy("comp").agg(F.count("*").alias("size")), "jaccard-sizes")
    comp = comp.join(sizes, "comp").select("class", "n", "gid", F.struct("size", "comp").alias("rank"))
    comp = materialise(comp, "jaccard-ranks")
    groups = materialise(comp.groupBy("gid").agg(F.max("rank").alias("top"), F.max("n").alias("largest"), F.min("n").alias("least")), "jaccard-bounds")
    placed_tokens = shared.select("token", "class").join(comp.select("class", "gid", F.col("rank.comp").alias("comp")), "class")
    bridges = placed_tokens.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
    bridges = materialise(bridges, "jaccard-bridges")
    between = materialise(placed_tokens.select("token", "class", "gid").join(bridges, "token"), "jaccard-between")
    matrix = materialise(between.select("token", "gid").distinct(), "jaccard-union")
    hits = between.select("token", F.col("class").alias("query")).join(matrix, "token").groupBy("query", "gid").agg(F.count("*").alias("overlap"))
    own = comp.select(F.col("class").alias("query"), F.col("n").alias("query_n"), F.col("rank").alias("query_rank"))
    asked = hits.join(own, "query").where(F.col("overlap") >= _least(F.col("query_n"), percent)).join(groups, "gid")
    asked = asked.where((F.col("top") > F.col("query_rank")) & (F.col("largest") * 100 >= F.col("query_n") * percent) & (F.col("query_n") * 100 >= F.col("least") * percent))
    asked = materialise(asked.select("query", "gid", F.col("query_rank.comp").alias("comp")), "jaccard-asked")
    salts = materialise(asked.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES).alias("salts")), "jaccard-salts")
    members = comp.select("class", "gid", F.col("rank.comp").alias("comp")).join(salts, "gid").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)))
    asked = asked.join(salts, "gid").select(F.col("query").alias("class"), "gid", "comp", F.pmod(F.xxhash64("query"), F.col("salts")).alias("salt"))
    rows = members.select("class", "gid", "comp", "salt", F.lit(0).alias("asks")).unionByName(asked.select("class", "gid", "comp", "salt", F.lit(1).alias("asks")))
    rows = rows.join(texts, "class").repartition("gid", "salt").sortWithinPartitions("gid", "salt", "asks")
    found = materialise(map_arrow(rows.select("gid", "salt", "asks", "class", "comp", "blob"), _open(width, percent), "u bigint, v bigint"), "jaccard-found")
    return sets.select("doc_id", "n", "class"), near.unionByName(found)


def _texts(d: DataFrame, placed: DataFrame, width: int, taken: np.ndarray) -> DataFrame:
    """(class, blob): a compressed text of each placed class."""
    known = None
    if placed.count() <= KNOWN:
        known = d.sparkSession.sparkContext.broadcast(np.sort(np.array([r["class"] for r in placed.select("class").collect()], np.int64)))

    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        import zstandard

        z, seen = zstandard.ZstdCompressor(level=3), set()
        for b in batches:
            for _, texts in _parts(b):
                cls, check = class_ids(*shingle_sets(texts, width))
                cls = np.where(np.isin(cls, taken), check, cls)
                if known is not None and len(known.value):
                    at = np.minimum(np.searchsorted(known.value, cls), len(known.value) - 1)
                    pick = np.flatnonzero(known.value[at] == cls)
                else:
                    pick = np.flatnonzero(cls) if known is None else []
                rows = []
                for i in pick:
                    if int(cls[i]) not in seen:
                        seen.add(int(cls[i]))
                        rows.append((int(cls[i]), z.compress(texts[i])))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    blobs = map_arrow(d, run, "class bigint, blob binary").groupBy("class").agg(F.first("blob").alias("blob"))
    return blobs if known is not None else blobs.join(placed.select("class"), "class", "left_semi")


def _unpack(blobs: list[bytes], width: int) -> list[np.ndarray]:
    import zstandard

    z = zstandard.ZstdDecompressor()
    h, st = shingle_sets([z.decompress(x) for x in blobs], width)
    return [h[a:b] for a, b in zip(st[:-1].tolist(), st[1:].tolist(), strict=True)]


def _linked(both: np.ndarray | int, n: np.ndarray | int, m: int, percent: int):
    return (100 + percent) * both >= percent * (n + m)


def _compare(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                cls, hub = part.column(0).to_pylist(), part.column(2).to_pylist()
                hub_blobs = dict(zip(hub, part.column(3).to_pylist(), strict=True))
                hub_sets = dict(zip(hub_blobs, _unpack(list(hub_blobs.values()), width), strict=True))
                out = []
                for c, k, x in zip(cls, hub, _unpack(part.column(1).to_pylist(), width), strict=True):
                    y = hub_sets[k]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if _linked(both, len(x), len(y), percent):
                        out.append((c, k))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], schema=schema)

    return run


class _Group:
    """Members of an opened group with an inverted index over their whole sets."""

    def __init__(self, cls: list[int], comp: list[int], sets: list[np.ndarray]):
        self.cls, self.comp = np.array(cls), np.array(comp)
        self.sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.union, first = np.unique(tokens[order], return_index=True)
        self.bounds = np.append(first, len(tokens))
        self.owners = np.repeat(np.arange(len(sets)), self.sizes)[order]

    def ask(self, query: int, comp: int, s: np.ndarray, percent: int) -> list[int]:
        """One linked member of each other component."""
        at = np.minimum(np.searchsorted(self.union, s), len(self.union) - 1)
        at = at[self.union[at] == s]
        if len(at) * 100 < percent * len(s):  # the bound on the overlap with the group's union
            return []
        lo, hi = self.bounds[at], self.bounds[at + 1]
        n = hi - lo
        places = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(self.owners[places], minlength=len(self.sizes))
        good = np.flatnonzero(_linked(both, self.sizes, len(s), percent) & (self.comp != comp) & (self.cls != query))
        _, first = np.unique(self.comp[good], return_index=True)
        return self.cls[good[first]].tolist()


def _open(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        key, held, group = None, [], None
        for b in batches:
            out = []
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                gid, salt, asks, cls, comp, blob = (c.to_pylist() for c in part.columns)
                for i, s in enumerate(_unpack(blob, width)):
                    if (gid[i], salt[i]) != key:
                        key, held, group = (gid[i], salt[i]), [], None
                    if not asks[i]:
                        held.append((cls[i], comp[i], s))
                        continue
                    if group is None:
                        group = _Group(*zip(*held, strict=True))
                        held = []
                    out += [(cls[i], m) for m in group.ask(cls[i], comp[i], s, percent)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*out, strict=True)], schema=schema)

    return run


def components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id."""
    sets, edges = links(docs, width, percent)
    roots = connected(edges).select(F.col("node").alias("class"), "root")
    classes = sets.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("first"))
    classes = classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    named = classes.join(classes.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("class", "component_id")
    full = sets.where("n > 0").join(named, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return full.unionByName(sets.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that with the smallest doc_id, with all its columns; texts without words all stay."""
    c = components(docs.select("doc_id", "text"), width, percent).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(c, "doc_id", "left_anti")
