"""N-gram Jaccard join (operator 9): PartEnum signatures.

Two documents link when the Jaccard similarity of their sets of shingles is at least
``num / den``: by default 3-word shingles and 0.9, the values of the op9 query. Sets are put in bands of size; two sets in a band ``[low, high)`` that
link differ in at most ``k`` elements, ``k = floor(2 high (1 - s) / (1 + s))``. The domain of
the elements is cut into ``n1`` parts, so in one part they differ in at most ``k // n1``;
that part is cut into ``n2`` pieces, of which at least ``n2 - k // n1`` agree. A signature is
made for each part and each choice of ``n2 - k // n1`` of its pieces, so sets that link share a
signature. Under a bound below 0.9 parts have few elements; there are some to spare then, and signatures of
common shingles alone are left out as far as the spare parts allow. A set makes those of its own band, and those of the next band if a linked partner may
lie there.

Sets that are equal are one class, found by grouping on a fingerprint. Signatures are made for one text of each class and
never stored. They are shuffled as sorted, delta-coded blocks of a few bytes an entry: a task sorts the signatures of
some thousand classes, cut to as many bits as their number needs, pairs the classes that share one there, and sends one entry for each signature to
the task of its range, which pairs those of several tasks. Cut signatures that agree by chance cost comparisons only. Classes that share a
signature, directly or through others, are a cluster: links never leave it. Clusters are found without
writing out pairs (a star in each signature, then connected components). Inside a cluster all
pairs are checked exactly on the sets, as products of incidence matrices. Small clusters are dealt
into tasks many at a time; a large one is cut into blocks by size, with a task for each pair of blocks whose sizes allow links, so no task
holds more than two blocks. A task returns, for each class, its number of links there and one link
towards the smallest member it is connected with, so rows grow with classes times blocks, not with pairs."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.base import arrow_limits, per_batch, pick, position, saved, scratch
from marketlens.llm.components import components, merge_labels
from marketlens.llm.shingles import mix, shingle_set

SHINGLE, NUM, DEN = 3, 90, 100    # link when DEN * intersection >= NUM * union
BAND = 1.3                        # ratio of a size band's ends
PIECES, FREE = 3, 1               # second level: pieces, and how many of them may differ
BLOCK_DOCS, BLOCK_SHINGLES = 2_048, 1 << 20   # a block of a large cluster, on average
BROADCAST_IDS = 500_000           # ids of classes that are broadcast at most
COMMON_DOCS, COMMON = 4_096, 65_536   # texts looked at for common shingles, about, and shingles at most
_TILE, _WIDTH = 1_024, 4_096      # rows and columns of an incidence matrix held at once


def bands(size: int, ratio: float = BAND) -> tuple[int, int, int]:
    """``(band, low, high)`` with ``low <= size < high``."""
    band, low = 0, 1
    while True:
        high = max(low + 1, int(low * ratio))
        if size < high:
            return band, low, high
        band, low = band + 1, high


def levels(high: int, num: int, den: int) -> tuple[int, int, int, int]:
    """``(parts, pieces, free, spare)`` for sets of fewer than ``high`` elements: ``spare + 1`` parts at least differ in at
    most ``free`` elements, of ``pieces`` pieces of a part."""
    k = 2 * (high - 1) * (den - num) // (den + num)   # most elements that differ
    if 10 * num >= 9 * den:
        # parts so many that one of them differs in at most FREE elements
        n1 = k // (FREE + 1) + 1
        free = k // n1
        return n1, PIECES if free else 1, free, 0
    # a lower bound makes parts of fewer elements: small sets are one part, others have parts to spare
    if k <= 3:
        return 1, 2 * k + 1 - (k == 3), k, 0
    if k <= 12:
        n1 = k // 4 + 1
        return n1, 7, k // n1, 0
    spare = k // 12 + 2
    return k + 1 + spare, 1, 0, spare


def _signatures_in(elements: np.ndarray, rare: np.ndarray, band: int, high: int, num: int, den: int) -> np.ndarray:
    """PartEnum signatures of a sorted set for one band (sizes below ``high``). Chosen pieces without any rare element
    are left out if at most ``spare`` parts have such a choice: one more part agrees, in pieces that have some. Which
    elements count as rare changes the number of signatures alone."""
    n1, n2, free, spare = levels(high, num, den)
    # elements are uniform hashes in order: equal ranges of the domain are runs
    width = (1 << 64) // (n1 * n2)
    cuts = np.searchsorted(elements, np.arange(1, n1 * n2, dtype=np.uint64) * np.uint64(width)) if n1 * n2 > 1 else np.empty(0, np.int64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements), dtype=np.uint64)])
    at = np.concatenate([[0], cuts, [len(elements)]])
    pieces = (sums[at[1:]] - sums[at[:-1]]).reshape(n1, n2)   # sums are the same for the same elements
    part = np.arange(n1, dtype=np.uint64) + (np.uint64(band) << np.uint64(40))
    # choices of the same part have different numbers
    choices = list(combinations(range(n2), n2 - free))
    factor = np.uint64(max(PIECES, len(choices)))
    filled = (np.diff(np.concatenate([[0], np.cumsum(rare)])[at]) > 0).reshape(n1, n2)
    weak = (n2 - filled.sum(1)) >= n2 - free     # some choice of the part is empty
    drop = spare > 0 and weak.sum() <= spare
    out = []
    for i, chosen in enumerate(choices):
        h = mix(part * factor + np.uint64(i))
        for j in chosen:
            h = mix(h + pieces[:, j])
        out.append(h[filled[:, chosen].any(1)] if drop else h)
    return np.concatenate(out)


def signatures(elements: np.ndarray, num: int = NUM, den: int = DEN, common: np.ndarray | None = None) -> np.ndarray:
    """Distinct signatures (int64) of a set; sets that link share one, whatever the sorted elements ``common``
    are (the same for all sets)."""
    size = len(elements)
    if not size:
        return np.empty(0, np.int64)
    band, low, high = bands(size)
    rare = np.ones(size, bool)
    if common is not None and len(common):
        rare = common[np.minimum(np.searchsorted(common, elements), len(common) - 1)] != elements
    out = [_signatures_in(elements, rare, band, high, num, den)]
    if size * den >= high * num:      # a linked partner may have ``high`` elements or more
        out.append(_signatures_in(elements, rare, band + 1, bands(high)[2], num, den))
    return np.unique(np.concatenate(out)).view(np.int64)


def _common(docs: DataFrame, n: int) -> np.ndarray:
    """Shingles that some texts of a bounded sample share, sorted. They only save signatures: any choice gives the same links."""
    total = docs.count()
    few = docs.filter(F.pmod(F.xxhash64(F.lit(23), "text"), F.lit(max(1, total))) < COMMON_DOCS).select("text").distinct()

    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, n) for t in batch.column(0).to_pylist()]
        return {"e": np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)}

    seen = per_batch(few, run, "e bigint").groupBy("e").count().filter("count >= 3").orderBy(F.desc("count"), "e").limit(COMMON)
    return np.sort(np.asarray(seen.select("e").toArrow().column(0), dtype=np.int64).view(np.uint64))


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n_shingles, f1, f2`` for each row."""
    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t, n) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "n_shingles": np.array([len(s) for s in sets], np.int64),
                "f1": np.array([int(s.sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64),
                "f2": np.array([int(mix(s).sum(dtype=np.uint64)) for s in sets], np.uint64).view(np.int64)}

    return per_batch(docs, run, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint")


def stars(sig: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of entries sorted by signature: which begin a new one, and the distinct pairs of the first document of
    a signature and each other that has it."""
    new = np.concatenate([np.ones(min(1, len(sig)), bool), sig[1:] != sig[:-1]])
    hub = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(sig) else doc
    pairs = np.unique(np.stack([hub, doc], 1)[hub != doc], axis=0)
    return new, pairs[:, 0], pairs[:, 1]


def packed(sigs: np.ndarray, owner: np.ndarray, docs: np.ndarray, bits: int, ranges: int) -> dict:
    """Blocks of signatures by range: ``sigs`` (uint64) of the rows ``owner`` of ``docs``. A signature goes with the first document
    that has it; the others that have it here are pairs with that one (``links``), so a signature that many documents share is one entry a
    block. A block has its first value, the steps between sorted values in as few bytes as the largest needs, and the
    owners' numbers among the block's documents. Pairs are dealt over the ranges."""
    cut = sigs >> np.uint64(64 - bits)
    order = np.lexsort((owner, cut))
    cut, owner = cut[order], owner[order]
    new, hub, other = stars(cut, owner)
    cut, owner = cut[new], owner[new]
    span = np.uint64(max(1, -(-(1 << bits) // ranges)))
    at = np.searchsorted(cut, np.arange(1, ranges, dtype=np.uint64) * span)
    dealt = hub % ranges
    out = {"part": [], "first": [], "steps": [], "owners": [], "docs": [], "links": []}
    for part, (a, b) in enumerate(zip(np.concatenate([[0], at]), np.concatenate([at, [len(cut)]]), strict=True)):
        pairs = np.stack([docs[hub[dealt == part]], docs[other[dealt == part]]], 1).ravel() if len(hub) else np.empty(0, np.int64)
        if a == b and not len(pairs):
            continue
        steps = np.diff(cut[a:b], prepend=cut[a:a + 1]) if b > a else np.empty(0, np.uint64)
        width = max(1, (int(steps.max()).bit_length() + 7) // 8) if b > a else 1
        mine, who = np.unique(owner[a:b], return_inverse=True)
        out["part"].append(part)
        out["first"].append(int(cut[a].astype(np.int64)) if b > a else 0)
        out["steps"].append(bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
        out["owners"].append(who.astype(np.uint16 if len(mine) <= 1 << 16 else np.uint32).tobytes())
        out["docs"].append(docs[mine])
        out["links"].append(pairs)
    return out


def unpacked(first: int, steps: bytes, owners: bytes, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and documents of a block."""
    width = steps[0]
    raw = np.frombuffer(steps, np.uint8, offset=1).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    values = np.cumsum(wide.view("<u8").ravel(), dtype=np.uint64) + np.uint64(first % (1 << 64))
    who = np.frombuffer(owners, np.uint16 if len(owners) == 2 * len(raw) else np.uint32)
    return values, docs[who]


_BLOCK = "part int, first bigint, steps binary, owners binary, docs array<bigint>, links array<bigint>"
FLUSH = 1 << 19           # signatures in a task's blocks at once
RANGE = 1 << 21           # signatures in a range, about


def shared_signatures(texts: DataFrame, classes: int, n: int, num: int, den: int, common: np.ndarray | None) -> DataFrame:
    """Pairs ``(hub, doc)`` of documents of ``texts`` (``doc_id, text``) that share a signature, cut short: for each signature a star, so
    that documents sharing one are connected."""
    each = 64 if 10 * num >= 9 * den else 256          # signatures of a class, about
    bits = min(64, max(40, (classes * each).bit_length() + 14))
    ranges = max(16, classes * each // RANGE)

    def blocks(batches):
        sigs, owner, docs, held = [], [], [], 0
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for i, t in enumerate(batch.column(1).to_pylist()):
                found = signatures(shingle_set(t, n), num, den, common).view(np.uint64)
                if len(found):
                    sigs.append(mix(found))
                    owner.append(np.full(len(found), len(docs), np.int64))
                    docs.append(ids[i])
                    held += len(found)
            if held >= FLUSH:
                yield pa.RecordBatch.from_pydict(packed(np.concatenate(sigs), np.concatenate(owner), np.array(docs, np.int64), bits, ranges), schema=schema)
                sigs, owner, docs, held = [], [], [], 0
        if held:
            yield pa.RecordBatch.from_pydict(packed(np.concatenate(sigs), np.concatenate(owner), np.array(docs, np.int64), bits, ranges), schema=schema)

    schema = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("steps", pa.binary()), ("owners", pa.binary()), ("docs", pa.list_(pa.int64())),
                        ("links", pa.list_(pa.int64()))])

    def twice(key, rows):
        names = ("first", "steps", "owners", "docs")
        found = [unpacked(f, s, o, np.array(d, np.int64)) for f, s, o, d in zip(*(rows.column(c).to_pylist() for c in names), strict=True)]
        sig, doc = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((doc, sig))
        _, hub, other = stars(sig[order], doc[order])
        there = np.asarray(rows.column("links").combine_chunks().flatten(), np.int64).reshape(-1, 2)
        return pa.table({"hub": np.concatenate([hub, there[:, 0]]), "doc": np.concatenate([other, there[:, 1]])})

    arrow_limits(texts.sparkSession)
    return texts.mapInArrow(blocks, _BLOCK).groupBy("part").applyInArrow(twice, "hub bigint, doc bigint").distinct()


def intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right (sorted sets)."""
    sides = []
    for sets in (left, right):
        sizes = [len(x) for x in sets]
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)))
    both = np.intersect1d(sides[0][0], sides[1][0])   # only shared elements count
    columns = []
    for elements, row in sides:
        at = np.searchsorted(both, elements)
        known = at < len(both)
        known[known] = both[at[known]] == elements[known]
        at, row = at[known], row[known]
        order = np.argsort(at, kind="stable")
        columns.append((at[order], row[order]))
    out = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(both), _WIDTH):
        tiles = []
        for (at, row), n in zip(columns, (len(left), len(right)), strict=True):
            i, j = np.searchsorted(at, (start, start + _WIDTH))
            tile = np.zeros((n, min(_WIDTH, len(both) - start)), np.float32)
            tile[row[i:j], at[i:j] - start] = 1.0
            tiles.append(tile)
        out += tiles[0] @ tiles[1].T    # counts below 2 ** 24 are exact
    return out


def _linked(left: list[np.ndarray], right: list[np.ndarray], same: bool, num: int = NUM, den: int = DEN) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs that link; ``same``: of one list, each pair once."""
    a, b = (np.array([len(x) for x in sets], np.int64) for sets in (left, right))
    found = []
    for i in range(0, len(left), _TILE):
        for j in range(i if same else 0, len(right), _TILE):
            both = intersections(left[i:i + _TILE], right[j:j + _TILE]).astype(np.int64)
            union = a[i:i + _TILE, None] + b[None, j:j + _TILE] - both
            x, y = np.nonzero((den * both >= num * union) & (union > 0))
            x, y = x + i, y + j
            keep = x < y if same else slice(None)
            found.append((x[keep], y[keep]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True)) if found else (np.empty(0, np.int64),) * 2


_FOUND = "doc bigint, links bigint, root bigint"


def _cell(key, rows, num: int, den: int):
    """Links among the classes of one task: of whole small clusters, or between two blocks of a large one."""
    _, low, high = (k.as_py() for k in key)
    doc, many, cluster, block = (np.asarray(rows.column(c)) for c in ("doc_id", "many", "cluster", "block"))
    sets = [np.frombuffer(x, np.uint64) for x in rows.column("elements").to_pylist()]
    order = np.argsort(doc, kind="stable")
    links, label = np.zeros(len(doc), np.int64), np.arange(len(doc))
    if low < 0:
        by_cluster = order[np.argsort(cluster[order], kind="stable")]
        cuts = np.flatnonzero(np.diff(cluster[by_cluster])) + 1
        jobs = [(part, part) for part in np.split(by_cluster, cuts)]
    else:
        a = order[block[order] == low]
        jobs = [(a, a if low == high else order[block[order] == high])]
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.arange(len(doc))      # labels follow the order of ids
    for a, b in jobs:
        i, j = _linked([sets[x] for x in a], [sets[x] for x in b], a is b, num, den)
        i, j = a[i], b[j]
        differ = doc[i] != doc[j]
        i, j = i[differ], j[differ]
        links += np.bincount(i, many[j], minlength=len(doc)).astype(np.int64) + np.bincount(j, many[i], minlength=len(doc)).astype(np.int64)
        merge_labels(label, rank[i], rank[j])
    some = np.flatnonzero(links)
    return pa.table({"doc": doc[some], "links": links[some], "root": doc[order[label[rank[some]]]]},
                    schema=pa.schema([("doc", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))


def each_text_once(rows: DataFrame, key: str, text: str, repeated: DataFrame | None) -> DataFrame:
    """One row of each ``key`` and ``text``. ``repeated`` holds the keys that more than one row has (as ``key``); None: there are none. The texts of
    the others are not shuffled."""
    if repeated is None:
        return rows
    ids = repeated.select(F.col("key").alias("_again"))
    once = rows.join(ids, F.col(key) == F.col("_again"), "left_anti")
    return once.unionByName(rows.join(ids, F.col(key) == F.col("_again"), "left_semi").dropDuplicates([key, text]))


def _repeated(rows: DataFrame, key: str) -> DataFrame | None:
    """Keys that more than one row has, for ``each_text_once``."""
    found = saved(rows.groupBy(F.col(key).alias("key")).count().filter("key is not null and count > 1").select("key"), "nj-repeated")
    return None if found.isEmpty() else found


def _clusters(links: DataFrame, classes: int) -> DataFrame:
    """``(doc_id, cluster)`` of the classes that share a signature with another, from ``hub, doc``."""
    top = components(links, "hub", "doc", 4 * classes)
    return saved(top.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
                 .unionByName(top.select(F.col("component").alias("doc_id"), F.col("component").alias("cluster")).distinct()), "nj-clusters", classes)


def near_copies(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """Documents link by sets of ``shingle`` words and a similarity of ``num / den`` or more. One row per input row: ``doc_id, n_shingles, component_id`` (smallest ``doc_id`` reachable by
    links, itself included), ``class_id`` (smallest with the same set), ``n_links`` (other documents
    linked directly). Null and empty texts have an empty set and link with nothing; a null ``doc_id`` keeps its row with null
    component and links with nothing. Rows that repeat a ``doc_id`` are one document: it links where
    any of its texts does, and each row keeps its own ``n_shingles`` and ``n_links``. An empty table gives no rows."""
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sets = saved(_sets(docs, shingle), "nj-sets")
    rows = sets.count()
    some = sets.filter("doc_id is not null and n_shingles > 0")
    same = ["n_shingles", "f1", "f2"]
    ids = some.select("doc_id", *same).distinct()
    repeats = ids.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    classes = saved(ids.groupBy(*same).agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("many")), "nj-classes", rows)
    member = saved(ids.join(classes, same).select("doc_id", *same, "class_id", "many"), "nj-members", rows)
    # rows of one id with different texts link as one document
    tied = member.join(repeats, "doc_id", "left_semi").select(F.col("class_id").alias("a"), F.col("doc_id").alias("b")).filter("a < b").distinct()
    common = _common(docs, shingle) if 10 * num < 9 * den else None
    n = classes.count()
    # a scan of all texts meets the classes' ids: broadcast while they are few, else a shuffled join
    first = classes.select(F.col("class_id").alias("doc_id")).distinct()
    texts = docs.join(F.broadcast(first) if n <= BROADCAST_IDS else first, "doc_id", "left_semi").select("doc_id", "text")
    clusters = _clusters(shared_signatures(texts, n, shingle, num, den, common), n)
    found = _cluster_links(docs, clusters, classes, n, shingle, num, den, _repeated(sets, "doc_id"))
    top = components(found.select(F.col("doc").alias("a"), F.col("root").alias("b")).unionByName(tied), "a", "b", n)
    near = found.groupBy(F.col("doc").alias("class_id")).agg(F.sum("links").alias("near"))
    # a component is named by its smallest id, and a class by the smallest with its set
    out = member.join(top.withColumnRenamed("node", "class_id"), "class_id", "left").join(near, "class_id", "left")
    out = out.select("doc_id", *same, "class_id", F.coalesce("component", "class_id").alias("component_id"), (F.col("many") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"))
    return sets.join(out, ["doc_id", *same], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def _lows(most: int = 1 << 40) -> list[int]:
    """First sizes of the bands."""
    out, low = [], 1
    while low < most:
        out.append(low)
        low = bands(low)[2]
    return out


def _cluster_links(docs: DataFrame, clusters: DataFrame, classes: DataFrame, many: int, n: int, num: int, den: int, repeated: DataFrame | None) -> DataFrame:
    """``doc, links, root`` of ``many`` classes from the pairs inside the clusters whose sizes allow a link. The texts of their classes are read again. A
    large cluster is cut into blocks by band of size, and a block meets those of its own band and of the bands beside it: sets
    that link are at most one band apart."""
    lows = _lows()
    band = (F.size(F.filter(F.array(*[F.lit(x) for x in lows]), lambda x: x <= F.col("n_shingles"))) - 1).alias("band")
    sized = clusters.join(classes.select(F.col("class_id").alias("doc_id"), "many", "n_shingles"), "doc_id")
    by_band = sized.groupBy("cluster", band).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    of = by_band.groupBy("cluster").agg(F.sum("docs").alias("docs"), F.sum("shingles").alias("shingles"),
                                        F.map_from_entries(F.collect_list(F.struct("band", blocks.alias("blocks")))).alias("per_band"))
    of = saved(of.withColumn("blocks", blocks), "nj-of", many)
    small = of.filter("blocks = 1").agg(F.sum("docs").alias("docs"), F.sum("shingles").alias("shingles")).first()
    bins = max(1, (small["docs"] or 0) // 256, (small["shingles"] or 0) // (BLOCK_SHINGLES // 2))
    info = sized.groupBy("doc_id", "cluster").agg(F.max("many").alias("many")).join(
        of.select("cluster", F.when(F.col("blocks") > 1, F.col("per_band")).alias("per_band")), "cluster")
    info = saved(info, "nj-info", many)
    # a scan of all texts meets the ids: broadcast while they are few, else a shuffled join
    few = info.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(info) if few else info, "doc_id").select("doc_id", "text", "cluster", "per_band", "many")
    texts = each_text_once(texts, "doc_id", "text", repeated)

    def run(batch: pa.RecordBatch) -> dict:
        out = {c: batch.column(c) for c in ("doc_id", "cluster", "per_band", "many")}
        sets = [shingle_set(t, n) for t in batch.column("text").to_pylist()]
        at = np.maximum(np.searchsorted(np.array(lows), [len(x) for x in sets], side="right") - 1, 0)
        return out | {"band": at.astype(np.int32), "elements": pa.array([x.tobytes() for x in sets], pa.binary())}

    rows = per_batch(texts, run, "doc_id bigint, cluster bigint, per_band map<int,int>, many bigint, band int, elements binary")
    large = F.col("per_band").isNotNull()
    bin_of = (F.lit(-1) - F.pmod(F.xxhash64(F.lit(22), "cluster"), F.lit(bins).cast("bigint"))).cast("int")

    def numbers(at) -> Column:
        """Blocks of a band; one for a band without classes."""
        count = F.coalesce(F.try_element_at("per_band", at), F.lit(1))
        return F.transform(F.sequence(F.lit(0), count - 1), lambda r: at * 65_536 + r)

    mine = F.col("band")
    own = F.element_at(numbers(mine), (F.pmod(F.xxhash64(F.lit(21), "doc_id"), F.size(numbers(mine)).cast("bigint")) + 1).cast("int"))
    rows = rows.withColumn("block", F.when(large, own).otherwise(0))
    others = F.concat(numbers(mine), numbers(mine + 1), F.when(mine > 0, numbers(mine - 1)).otherwise(F.array().cast("array<int>")))
    cells = rows.withColumn("other", F.explode(F.when(large, others).otherwise(F.array(F.lit(0))))).select(
        F.when(large, F.col("cluster")).otherwise(0).alias("large"),
        F.when(large, F.least("block", "other")).otherwise(bin_of).alias("low"),
        F.when(large, F.greatest("block", "other")).otherwise(bin_of).alias("high"), "doc_id", "cluster", "block", "many", "elements")

    def check(key, rows):
        return _cell(key, rows, num, den)

    return saved(cells.groupBy("large", "low", "high").applyInArrow(check, _FOUND), "nj-links")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is its component's smallest; rows with a null ``doc_id``
    stay. Same columns. Of rows that repeat an id with the same text one stays; every different text of a
    repeated id stays."""
    key, text = (f"_in{position(docs, n)}" for n in ("doc_id", "text"))
    flat = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])
    with scratch(docs.sparkSession) as stays:
        repeated = flat.groupBy(F.col(key).alias("key")).count().filter("key is not null and count > 1").select("key")
        repeated = stays(repeated, "nj-repeated")
        keep = near_copies(docs, shingle, num, den).filter("doc_id = component_id").select(F.col("doc_id").alias("_keep")).distinct()
        keep = stays(keep, "nj-keep", docs.count())
    named = flat.filter(F.col(key).isNotNull()).join(keep, F.col(key).cast("bigint") == F.col("_keep"), "left_semi")
    named = each_text_once(named, key, text, None if repeated.isEmpty() else repeated)
    return named.unionByName(flat.filter(F.col(key).isNull())).toDF(*docs.columns)
