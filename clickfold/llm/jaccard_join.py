"""N-gram Jaccard join with signature trees.

A document is the set of its word shingles (as 64-bit hashes).  Equal sets
are one class; one document stands for it.  Two sets link when their Jaccard
similarity reaches ``percent``.

*Blocks.*  Linked sets of sizes n <= m differ in at most
d = n * (100 - percent) / percent shingles, so if the space of shingles is
cut into d + 1 + e parts, they agree in e + 1 parts at least, and in one that
is not empty if one of them has e empty parts at most.  Sets that agree in a
part (by a hash of its content) are candidates; a set with more empty parts
is cut anew by further hash functions, as is its partner.  Shingles that very
many documents share (common passages and lines) are left out of the first
cut: the bound holds for any cut, and without them such documents do not
meet.  The connected components of the candidates are the blocks; nothing
that links is lost.

*Signature trees.*  Within a block a tree is built over the sets, ordered by
size and smallest hashes.  Nodes hold the OR of the bitmaps below and the
range of sizes.  A traversal of pairs of nodes prunes those whose sizes or
whose largest possible overlap cannot reach the threshold; pairs of documents
that are left are compared exactly unless they are connected already.

*Large blocks* are dealt to sub-blocks, to each of which some pivots of the
whole block are added.  What then is not in the block's largest component is
compared with the sub-blocks of the levels of size that can link with it, so
that a large group of near copies costs no all-pairs comparison and no link
is lost.  Trees of bitmaps alone (half a byte per shingle) go first; whole
texts are sent only for the documents of pairs that these leave.

Cases: NULL or blank text has the empty set and links with nothing; a text
shorter than a shingle is one shingle; rows with equal sets are one class,
whatever their doc_ids: two texts under one doc_id are two documents, and a
row with a NULL doc_id links like any other but names no component (one
without any doc_id has a NULL name); a very long text is one row of a task;
of equal sets and components the smallest doc_id stands, then the smallest
hash of the text; an empty table gives an empty result; only ``doc_id`` and
``text`` are read, other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickfold.llm.common import components, hold_only
from clickfold.llm.token_memo import text_batches
from clickfold.session import delete_table, write_table

# Memory and layout parameters; none of them changes a result.
VOCABULARY = 250_000        # word hashes a worker remembers
HOT_CHUNK = 1_500_000       # shingles looked at together for frequent ones
HOT_COUNT = 5               # frequent: in so many different sets of a chunk
HOT_LIMIT = 200_000         # most frequent shingles that are broadcast (8 bytes each)
SEEDS = 6                   # cuts tried before empty parts count as content
BLOCK = 128                 # documents of a sub-block
BLOCK_SHINGLES = 200_000
PIVOTS = 16
CROSS = 4096                # documents of a sub-block in the cross comparison,
CROSS_SHINGLES = 2_000_000  # and their shingles, but
CROSS_LEAST = 512           # so many documents in any case
PAIRS = 8192                # pairs of nodes that a traversal opens at once
KEYS_TEXT = 2_000_000       # bytes of text whose keys a worker holds at once
SLICES = 1024               # groups in which candidate keys are exchanged

_U = np.uint64
_vocabulary: dict[bytes, int] = {}


def _word_ids(words: list[bytes]) -> np.ndarray:
    import xxhash

    hold_only(_vocabulary)
    if len(_vocabulary) > VOCABULARY:
        _vocabulary.clear()
    known = _vocabulary
    try:
        return np.fromiter(map(known.__getitem__, words), _U, len(words))
    except KeyError:
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), _U, len(words))


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers byte plane by byte plane, which compresses better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(b: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(kind).ravel()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, _U)
    ids, n = _word_ids(words), len(words)
    span = min(width, n)
    h = np.full(n - span + 1, span, _U)
    for k in range(span):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + ids[k:n - span + 1 + k])
    return np.unique(h)


class Cuts:
    """Part signatures of sets for one threshold."""

    def __init__(self, percent: int, hot: np.ndarray):
        self.percent, self.hot = percent, hot
        ratio, s = (100 / percent) ** 1.8, self.differences_reach()
        self.starts = [s]
        while self.starts[-1] < 1 << 40:
            s = self.starts[-1]
            self.starts.append(max(s + 1, int(s * ratio)))

    def differences(self, n: int) -> int:
        return n * (100 - self.percent) // self.percent

    def differences_reach(self) -> int:
        """The smallest size at which different sets can link."""
        n = 1
        while not self.differences(n):
            n += 1
        return n

    def keys(self, h: np.ndarray) -> np.ndarray:
        """The 64-bit candidate keys of a set."""
        n = len(h)
        if n < self.starts[0]:
            return np.zeros(0, _U)
        low = np.searchsorted(self.starts, n, "right") - 1
        high = np.searchsorted(self.starts, n * 100 // self.percent, "right") - 1
        keys = []
        for level in range(low, high + 1):
            d = self.differences(self.starts[level + 1] - 1)
            spare = d // 4
            parts = d + 1 + spare
            for seed in range(SEEDS + 1):
                if seed == 0:
                    x = h
                    if len(self.hot):
                        at = np.minimum(np.searchsorted(self.hot, h), len(self.hot) - 1)
                        x = h[self.hot[at] != h]
                else:
                    x = _mix(h + _U(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
                part = ((x >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
                content = np.zeros(parts, _U)
                np.add.at(content, part, _mix(x ^ _U(0xD6E8FEB86659FD93)))
                full = np.bincount(part, minlength=parts) > 0
                last = seed == SEEDS
                where = np.arange(parts) if last else np.flatnonzero(full)
                tag = _mix(_U(level << 40 | seed << 32) + where.astype(_U))
                keys.append(_mix(content[where] + tag))
                if parts - full.sum() <= spare:
                    break
        return np.concatenate(keys)


def _row_key() -> list:
    """``doc_id`` and ``txt``: what tells documents apart."""
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("txt")]


def _plain_key(doc_id: str = "doc_id", txt: str = "txt") -> list:
    """``_no, _d, _t``: the same as columns without NULLs, so that a join by
    them deals rows as a grouping by them does and texts are sent once."""
    return [F.isnull(doc_id).alias("_no"), F.coalesce(doc_id, F.lit(0)).alias("_d"),
            F.col(txt).alias("_t")]


def describe(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, txt, n, digest`` per document (``txt`` is a hash of its text),
    and rows with ``hot`` (shingles that are frequent among different sets of
    a chunk, with counts)."""
    def run(batches):
        import xxhash

        chunk: dict[bytes, np.ndarray] = {}
        size = 0

        def frequent():
            h, n = np.unique(np.concatenate(list(chunk.values())), return_counts=True)
            keep = n >= HOT_COUNT
            return h[keep], n[keep]

        def hot_rows(h, n):
            k = len(h)
            return pa.RecordBatch.from_arrays(
                [*(pa.nulls(k, pa.int64()) for _ in range(3)), pa.nulls(k, pa.binary()),
                 pa.array(h.astype(np.int64)), pa.array(n)],
                ["doc_id", "txt", "n", "digest", "hot", "seen"])

        for batch, texts in text_batches(batches):
            sizes, digests = [], []
            for t in texts:
                h = shingles(t, width)
                sizes.append(len(h))
                digest = xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None
                digests.append(digest)
                if digest is not None and digest not in chunk:
                    chunk[digest] = h
                    size += len(h)
                    if size > HOT_CHUNK:
                        yield hot_rows(*frequent())
                        chunk.clear()
                        size = 0
            k = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("txt"), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())],
                ["doc_id", "txt", "n", "digest", "hot", "seen"])
        if chunk:
            yield hot_rows(*frequent())

    return docs.select(*_row_key(), "text").mapInArrow(
        run, "doc_id long, txt long, n long, digest binary, hot long, seen long")


def _candidate_edges(docs: DataFrame, width: int, cuts: Cuts) -> DataFrame:
    """Edges ``a, b`` that connect all classes with a common key, a class by
    the first 40 bits of its set's digest (two classes that agree in these
    meet in a block and are told apart there).

    Tasks join classes with a common key at once and send each key once, to
    one of SLICES groups, as packed arrays; so a key that very many documents
    share comes once from each batch.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cuts)

    def stars(keys: np.ndarray, nodes: np.ndarray):
        """The first (smallest) node per key, and an edge to it from others."""
        order = np.lexsort((nodes, keys))
        keys, nodes = keys[order], nodes[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = nodes[np.flatnonzero(new)][np.cumsum(new) - 1] if len(keys) else nodes
        edges = np.unique(np.stack([first[~new], nodes[~new]], 1), axis=0)
        return keys[new], nodes[new], edges[edges[:, 0] != edges[:, 1]]

    def pack(batches):
        import xxhash

        own = shared.value
        for batch, texts in text_batches(batches, KEYS_TEXT):
            keys, nodes = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
            for t in set(texts):
                h = shingles(t, width)
                k = own.keys(h)
                if len(k):
                    d = int.from_bytes(xxhash.xxh3_128_digest(h.tobytes())[:5], "big")
                    keys.append(k)
                    nodes.append(np.full(len(k), d, np.int64))
            k, v, edges = stars(np.concatenate(keys), np.concatenate(nodes))
            slot = (k >> _U(54)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            k, v, slot = k[order], v[order], slot[order]
            at = np.flatnonzero(np.diff(slot, prepend=-1))
            ends = np.append(at[1:], len(slot))
            slots = slot[at].tolist()
            rows = [(s, _planes(k[i:j]), _planes(v[i:j])) for s, i, j in zip(slots, at, ends)]
            for e in np.array_split(edges, max(1, len(edges) // 4096)):
                if len(e):
                    rows.append((int(e[0, 0]) % SLICES, None, e.tobytes()))
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary()),
                     pa.array(cols[2], pa.binary())], ["slot", "keys", "nodes"])

    def meet(batches):
        """All rows of some slots, in the order of slots."""
        held, keys, nodes = None, [], []

        def flush():
            _, _, edges = stars(np.concatenate(keys), np.concatenate(nodes))
            return edge_batch(edges)

        def edge_batch(edges):
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(edges[:, 0])),
                                               pa.array(np.ascontiguousarray(edges[:, 1]))],
                                              ["a", "b"])

        for batch in batches:
            for slot, k, v in zip(*(batch.column(c).to_pylist() for c in ("slot", "keys", "nodes"))):
                if k is None:
                    yield edge_batch(np.frombuffer(v, np.int64).reshape(-1, 2))
                    continue
                if slot != held and keys:
                    yield flush()
                    keys, nodes = [], []
                held = slot
                keys.append(_from_planes(k, _U))
                nodes.append(_from_planes(v, np.int64))
        if keys:
            yield flush()

    packed = docs.select("text").mapInArrow(
        pack, "slot long, keys binary, nodes binary")
    return (packed.repartition("slot").sortWithinPartitions("slot")
            .mapInArrow(meet, "a long, b long").where("a != b"))


def map_bits(wanted: float) -> int:
    """A power of two from 256 to 16,384."""
    return 1 << int(np.clip(np.ceil(np.log2(max(wanted, 1))), 8, 14))


def bitmap(s: np.ndarray, bits: int) -> np.ndarray:
    """A set as ``bits`` bits; that of half the bits is the OR of the halves."""
    out = np.zeros(bits // 64, _U)
    at = s & _U(bits - 1)
    np.bitwise_or.at(out, (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
    return out


def fold(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of several lengths, all brought to the shortest."""
    least = min(map(len, maps))
    return np.stack([np.bitwise_or.reduce(m.reshape(-1, least), axis=0) for m in maps])


def smallest(s: np.ndarray) -> tuple[int, int]:
    return (s[0], s[min(1, len(s) - 1)]) if len(s) else (0, 0)


class Tree:
    """Levels of bitmaps over sets, from the documents up."""

    FAN = 8

    def __init__(self, maps: np.ndarray, n: np.ndarray, first: np.ndarray, second: np.ndarray):
        """``maps``: a bitmap per set; ``n``: the sizes; ``first``, ``second``:
        the smallest hashes, which bring similar sets together."""
        step = np.log(np.maximum(n, 1)) // np.log(1.12)
        self.order = np.lexsort((second, first, step))
        maps, n = maps[self.order], n[self.order]
        level = (maps, n, n, n - np.bitwise_count(maps).sum(1, dtype=np.int64))
        self.levels = [level]
        while len(level[0]) > self.FAN:
            cut = np.arange(0, len(level[0]), self.FAN)
            level = (np.bitwise_or.reduceat(level[0], cut), np.minimum.reduceat(level[1], cut),
                     np.maximum.reduceat(level[2], cut), np.maximum.reduceat(level[3], cut))
            self.levels.append(level)

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Tree:
        n = np.array([len(s) for s in sets], np.int64)
        bits = map_bits(4 * np.median(n))
        ends = np.array([smallest(s) for s in sets], _U)
        return cls(np.stack([bitmap(s, bits) for s in sets]), n, ends[:, 0], ends[:, 1])

    def _prune(self, k: int, a: np.ndarray, b: np.ndarray, percent: int):
        maps, low, high, spill = self.levels[k]
        ok = (100 * high[a] >= percent * low[b]) & (100 * high[b] >= percent * low[a])
        a, b = a[ok], b[ok]
        keep = np.zeros(len(a), bool)
        for i in range(0, len(a), 8192):
            x, y = a[i:i + 8192], b[i:i + 8192]
            most = np.bitwise_count(maps[x] & maps[y]).sum(1, dtype=np.int64)
            most += np.minimum(spill[x], spill[y])
            keep[i:i + 8192] = (100 + percent) * most >= percent * (low[x] + low[y])
        return a[keep], b[keep]

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of documents (positions in the list given) that may link."""
        none = np.zeros(0, np.int64)
        a, b = zip((none, none), *self.some_pairs(percent))
        return np.concatenate(a), np.concatenate(b)

    def some_pairs(self, percent: int):
        """``pairs``, some at a time: few pairs of nodes are open at once, so
        that memory does not grow with the square of the sets."""
        top = len(self.levels) - 1
        a, b = self._prune(top, *np.triu_indices(len(self.levels[top][0])), percent)
        todo = [(top, a, b)]
        kids = np.arange(self.FAN)
        while todo:
            k, a, b = todo.pop()
            if len(a) > PAIRS and k:
                todo.append((k, a[PAIRS:], b[PAIRS:]))
                a, b = a[:PAIRS], b[:PAIRS]
            if k == 0:
                ok = a < b
                yield self.order[a[ok]], self.order[b[ok]]
                continue
            size = len(self.levels[k - 1][0])
            a = (a[:, None, None] * self.FAN + kids[:, None]).repeat(self.FAN, 2).ravel()
            b = (b[:, None, None] * self.FAN + kids[None, :]).repeat(self.FAN, 1).ravel()
            ok = (a <= b) & (b < size)
            a, b = self._prune(k - 1, a[ok], b[ok], percent)
            if len(a):
                todo.append((k - 1, a, b))


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if not len(x) or not len(y):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def forest(sets: list[np.ndarray], percent: int, group: list | None = None,
           wanted: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all linked documents.  ``group``: documents of the
    same group are connected already; ``wanted``: at least one of a pair."""
    if len(sets) < 2:
        return []
    first: dict = {}
    up = [first.setdefault(g, i) for i, g in enumerate(group)] if group else list(range(len(sets)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    links = []
    for a, b in Tree.of(sets).some_pairs(percent):
        if wanted is not None:
            ok = wanted[a] | wanted[b]
            a, b = a[ok], b[ok]
        for i, j in zip(a.tolist(), b.tolist()):
            x, y = root(i), root(j)
            if x != y and similar(sets[i], sets[j], percent):
                up[max(x, y)] = min(x, y)
                links.append((i, j))
    return links


def _tree_join(blocks: DataFrame, keys: list[str], width: int, percent: int) -> DataFrame:
    """Links ``a, b`` within each block of rows ``node, text, grp, wanted``."""
    def run(key, table):
        node = table["node"].to_pylist()
        sets = [shingles(t, width) for t in table["text"].to_pylist()]
        found = forest(sets, percent, table["grp"].to_pylist(), np.array(table["wanted"].to_pylist()))
        return pa.table({"a": pa.array([node[i] for i, _ in found], pa.int64()),
                         "b": pa.array([node[j] for _, j in found], pa.int64())})

    return blocks.groupBy(*keys).applyInArrow(run, "a long, b long")


def _signatures(members: DataFrame, width: int) -> DataFrame:
    """``node, sign``: the two smallest hashes of a set and its bitmap, of two
    to four bits per shingle."""
    def run(batches):
        for batch, texts in text_batches(batches):
            signs = []
            for t in texts:
                s = shingles(t, width)
                signs.append(np.array(smallest(s), _U).tobytes()
                             + bitmap(s, map_bits(2 * len(s))).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(signs, pa.binary())],
                                             ["node", "sign"])

    return members.select("node", "text").mapInArrow(run, "node long, sign binary")


def _screen(blocks: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """The rows of ``keys, node, size, sign, grp, wanted`` that have a partner
    in their group (not of the same ``grp``, one of them wanted) which the tree
    of bitmaps does not exclude; each once, however many partners it has."""
    def run(key, table):
        signs = [np.frombuffer(x, _U) for x in table["sign"].to_pylist()]
        ends = np.array([x[:2] for x in signs])
        tree = Tree(fold([x[2:] for x in signs]), table["size"].to_numpy(), ends[:, 0], ends[:, 1])
        grp, wanted = (np.array(table[c].to_pylist()) for c in ("grp", "wanted"))
        partner = np.zeros(table.num_rows, bool)
        for a, b in tree.some_pairs(percent):
            ok = (grp[a] != grp[b]) & (wanted[a] | wanted[b])
            partner[a[ok]] = partner[b[ok]] = True
        return table.select([*keys, "node", "grp", "wanted"]).take(np.flatnonzero(partner))

    fields = {f.name: f.dataType.simpleString() for f in blocks.schema.fields}
    return blocks.groupBy(*keys).applyInArrow(
        run, ", ".join(f"{c} {fields[c]}" for c in [*keys, "node", "grp", "wanted"]))


def _hot_shingles(described: DataFrame) -> np.ndarray:
    rows = (described.where("hot IS NOT NULL").groupBy("hot").agg(F.sum("seen").alias("s"))
            .orderBy(F.desc("s"), "hot").limit(HOT_LIMIT).select("hot").toArrow())
    return np.sort(rows["hot"].to_numpy().astype(np.int64).view(_U))


def linked_rows(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``doc_id, txt, n, digest`` per row of ``docs``; ``class_id``, the
    smallest doc_id with an equal set, and ``head``, the row (``doc_id, txt``)
    that stands for all that links reach (both NULL for an empty set)."""
    described = write_table(describe(docs, width), name="sets")
    own = described.where("hot IS NULL").select("doc_id", "txt", "n", "digest")
    # A class stands by its row with the smallest doc_id (NULL last) and text.
    stand = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "txt")
    classes = own.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(stand).alias("stand"), F.max("n").alias("size"))
    # Numbered as they are written: unique, and fixed from then on.
    classes = write_table(classes.withColumn("node", F.monotonically_increasing_id()), name="classes")
    cuts = Cuts(percent, _hot_shingles(described))

    # Blocks: components of the candidates.
    blocks = write_table(components(_candidate_edges(docs, width, cuts)), name="blocks")
    short = F.conv(F.hex(F.substring("digest", 1, 5)), 16, 10).cast("long")
    inside = write_table(
        classes.withColumn("short", short).join(blocks.withColumnRenamed("node", "short"), "short")
        .select("node", "component", "size", "stand.doc_id", "stand.txt"), name="members")
    sizes = write_table(
        inside.groupBy("component").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("all"))
        .where("docs > 1")
        .withColumn("parts", F.ceil(F.greatest(F.col("docs") / BLOCK, F.col("all") / BLOCK_SHINGLES))
                    .cast("long")), name="block_sizes")
    inside = inside.join(sizes, "component")
    texts = docs.select(*_row_key(), "text").select(*_plain_key(), "text")
    members = write_table(
        inside.select(*_plain_key(), "node", "component", "docs", "parts", "size")
        .join(texts, ["_no", "_d", "_t"]).dropDuplicates(["_no", "_d", "_t", "node"])
        .select("node", "component", "docs", "parts", "size", "text",
                F.pmod(F.xxhash64("node"), F.lit(1 << 30)).alias("spot")), name="block_texts")

    # Each sub-block by itself, with some pivots of its block.
    pivot = (F.col("parts") > 1) & (F.col("spot") * F.col("docs") < PIVOTS << 30)
    at_home = F.array(F.pmod(F.col("spot"), F.col("parts")))
    everywhere = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    dealt = members.select("component", "node", "text", F.explode(
        F.when(pivot, everywhere).otherwise(at_home)).alias("part"),
        F.col("node").alias("grp"), F.lit(True).alias("wanted"))
    links = write_table(_tree_join(dealt, ["component", "part"], width, percent), name="links")

    # Large blocks: what is outside the largest component against everything.
    large = members.where("parts > 1")
    if not large.isEmpty():
        now = write_table(components(links).withColumnRenamed("component", "now"), name="now")
        named = F.coalesce("now", "node")
        # Linked sets are in the same or neighbouring levels of size.
        level = F.floor(F.log(F.col("size").cast("double")) / math.log(100 / percent) + 1e-9)
        large = large.withColumn("level", level.cast("long"))
        narrow = write_table(large.select("component", "node", "level", "size").join(now, "node", "left")
                             .select("component", "node", "level", "size", named.alias("now")),
                             name="narrow")
        main = (narrow.groupBy("component", "now").agg(F.count(F.lit(1)).alias("c"))
                .groupBy("component").agg(F.max(F.struct("c", F.negate("now").alias("m"))).alias("x"))
                .select("component", F.negate(F.col("x.m")).alias("main")))
        main = write_table(main, name="main")
        outside = F.col("now") != F.col("main")

        def slots(n, shingles):
            parts = F.greatest(n / CROSS, F.least(n / CROSS_LEAST, shingles / CROSS_SHINGLES))
            return F.ceil(F.coalesce(parts, F.lit(0.0))).cast("long")

        levels = write_table(
            narrow.join(main, "component").groupBy("component", "level").agg(
                slots(F.count(F.lit(1)), F.sum("size")).alias("wide"),
                slots(F.count_if(outside), F.sum(F.when(outside, F.col("size")))).alias("rest")),
            name="levels")
        large = (large.join(main, "component").join(now, "node", "left").withColumn("now", named)
                 .join(levels, ["component", "level"]))
        beside = levels.select("component", F.col("level").alias("near"), F.col("wide").alias("near_wide"),
                               F.col("rest").alias("near_rest"))
        large = large.withColumn("near", F.explode(F.array(
            F.col("level") - 1, F.col("level"), F.col("level") + 1))).join(beside, ["component", "near"])
        place = F.shiftright("spot", 7)
        signs = write_table(_signatures(members.where("parts > 1"), width), name="signatures")
        large = large.drop("text").join(signs, "node")
        base = ["component", "node", "size", "sign", F.col("now").alias("grp")]
        mine = large.where(outside).select(
            *base, F.lit(True).alias("wanted"), F.col("level").alias("of"),
            F.pmod(place, F.col("rest")).alias("part"), F.col("near").alias("to"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("near_wide") - 1)).alias("other"))
        all_of = large.where("near_rest > 0").select(
            *base, F.lit(False).alias("wanted"), F.col("near").alias("of"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("near_rest") - 1)).alias("part"),
            F.col("level").alias("to"), F.pmod(place, F.col("wide")).alias("other"))
        group = ["component", "of", "part", "to", "other"]
        left = write_table(_screen(mine.unionByName(all_of), group, percent), name="screened")
        cross = write_table(_tree_join(left.join(members.select("node", "text"), "node"),
                                       group, width, percent), name="cross_links")
        links = links.unionByName(cross)
        delete_table(signs)
    delete_table(members)
    linked = write_table(components(links).join(classes.select("node", "stand"), "node"), name="linked")
    # A component stands by the smallest row of its classes.
    heads = linked.groupBy("component").agg(F.min("stand").alias("head"))
    heads = write_table(linked.join(heads, "component").select("node", "head"), name="heads")
    named = write_table(classes.join(heads, "node", "left").select(
        "digest", F.col("stand.doc_id").alias("class_id"), F.coalesce("head", "stand").alias("head")),
        name="named")
    return own.join(named, "digest", "left")


def join(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id``: the class is the
    smallest doc_id with an equal set, the component the smallest doc_id that
    links reach (the document itself included)."""
    return linked_rows(docs, width, percent).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id"))
        .alias("component_id"),
        F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
        .alias("class_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows that stand for their component (the smallest doc_id of it, a
    NULL last, then the smallest hash of the text), with all their columns.
    Rows with equal doc_id and text are one document, of which one row stays;
    rows without words link with nothing and stay."""
    found = linked_rows(docs, width, percent)
    stands = F.col("head.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("head.txt") == F.col("txt"))
    kept = write_table(found.where(F.col("digest").isNull() | stands).select(*_plain_key()).distinct(),
                       name="kept")
    d, txt = _row_key()
    rows = docs.select(d.alias("_id"), txt.alias("_txt"), F.struct(
        *[F.col(c) for c in docs.columns]).alias("_row")).select(*_plain_key("_id", "_txt"), "_row")
    key = ["_no", "_d", "_t"]
    rows = rows.join(kept, key, "left_semi").dropDuplicates(key)
    return rows.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
