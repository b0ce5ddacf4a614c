"""Near-duplicate documents by MinHash signatures and an inverted join of their coordinates.

A document's words give a set of shingles; its signature holds the minimum of each of
SIGNATURE hash functions over the set. Two documents of Jaccard similarity s agree in each
coordinate with probability s. A posting is a document under one (coordinate, value) pair.

* Documents of equal sets are one class and only its smallest id goes on.
* Prefix: of the first POSTED coordinates, those whose values fewest documents share come
  first. A pair that agrees in at least MATCHES of them must share one of the first
  ``POSTED - MATCHES + 1`` of either, so only those are posted; frequent values are hardly
  ever among them, and values of one document need no posting.
* Skip: a posting list first meets its hub, the document whose values are shared most, and
  each document is confirmed with the hub that it agrees with most. Confirmed links join
  documents into components. Lists whose documents are in one component are then skipped; in
  the others only pairs between components remain, taken from the documents outside the
  list's largest component. So a group of near copies costs about its size, and no pair that
  could join two components is left out.
* Collisions of those pairs are counted inside their lists, in blocks of bounded size. What
  leaves a block is not its pairs but the documents that have one: the pair agrees in
  MATCHES posted coordinates and in LEAST_ESTIMATE of all, and meets here first.
* Shingle hashes of these documents are sent to the same blocks once, and confirmed there on
  the full sets. A block returns a spanning forest of its links, so the output never exceeds
  the documents that came in, however many of their pairs are similar.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import chunks, connected_components, to_batch
from tenura.sources.shared import materialize

# Hash functions, and the share of them that must agree. At similarity 0.8 a smaller share
# agrees in about one pair of 100,000.
SIGNATURE = 256
LEAST_ESTIMATE = 0.69
# Posted coordinates, and least agreements in them: fewer in four pairs of a million.
POSTED = 16
MATCHES = 5
# Documents of one list, and shingles of theirs, that are compared with others in one place.
LIST_ROWS = 512
LIST_SHINGLES = 400_000
# Documents that are compared with those in one place.
PROBE_ROWS = 4096
_REMEMBERED = 400_000
_U64 = np.uint64


def words_of(text: str) -> list[bytes]:
    """Words between the white space of ``[\\x20\\x09-\\x0D]+``; A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], n: int) -> set:
    """Distinct shingles of n words; all words are one if they are fewer."""
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(n))))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(29))) * _U64(0x9E3779B97F4A7C15)
    return x ^ (x >> _U64(32))


class Signer:
    """Set sizes, digests and signatures of texts."""

    def __init__(self, n: int, signature: int = SIGNATURE, seed: int = 7):
        random = np.random.default_rng(seed)
        self.n = n
        self.powers = random.integers(1, 1 << 63, n + 1, dtype=np.uint64) * _U64(2) + _U64(1)
        self.a = random.integers(1, 1 << 63, signature, dtype=np.uint64) * _U64(2) + _U64(1)
        self.b = random.integers(0, 1 << 63, signature, dtype=np.uint64)
        self.hashes = _Hashes()

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the shingles."""
        count = len(words)
        if not count:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, count)
        n = min(self.n, count)
        total = np.full(count - n + 1, int(self.powers[self.n]) * n % (1 << 64), np.uint64)
        for i in range(n):
            total += h[i : count - n + 1 + i] * self.powers[i]
        return np.unique(_mixed(total))

    def sign(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of 32-bit minima for each set, which isn't empty."""
        out = np.empty((len(sets), len(self.a)), np.uint32)
        begin = 0
        while begin < len(sets):  # so many shingles at a time as a cache holds
            end, size = begin, 0
            while end < len(sets) and (end == begin or size + len(sets[end]) <= 16_384):
                size += len(sets[end])
                end += 1
            flat = np.concatenate(sets[begin:end])
            starts = np.cumsum([0] + [len(s) for s in sets[begin : end - 1]])
            for k, (a, b) in enumerate(zip(self.a, self.b)):
                values = ((flat * a + b) >> _U64(32)).astype(np.uint32)
                out[begin:end, k] = np.minimum.reduceat(values, starts)
            begin = end
        return out


def describe(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, postings (coordinate and value as longs), signature.

    The signature has the posted minima in full and the low byte of each other one.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
         ("postings", pa.list_(pa.int64())), ("signature", pa.binary())]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(words)
        coordinate = np.arange(POSTED, dtype=np.int64) << 32
        for rows in chunks(batches):
            sets = [signer.shingles(words_of(r[1])) for r in rows]
            full = [s for s in sets if len(s)]
            signed = signer.sign(full) if full else np.zeros((0, SIGNATURE), np.uint32)
            posted = iter((signed[:, :POSTED].astype(np.int64) | coordinate).tolist())
            short = iter(np.hstack([
                np.ascontiguousarray(signed[:, :POSTED]).view(np.uint8), signed[:, POSTED:].astype(np.uint8)
            ]))
            yield to_batch(
                schema,
                [
                    [r[0] for r in rows],
                    [len(s) for s in sets],
                    [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    [next(posted) if len(s) else None for s in sets],
                    [next(short).tobytes() if len(s) else None for s in sets],
                ],
            )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, n_shingles long, digest binary, postings array<long>, signature binary"
    )


def prefixes(classes: DataFrame) -> DataFrame:
    """doc, n, prefix, score, posted: shared ones among the rarest coordinates of each document.

    The score is how often the document's values are shared in all; ``posted`` has the bits
    of the prefix's coordinates.
    """
    every = classes.select("doc", "n", F.explode("postings").alias("key"))
    shared = every.groupBy("key").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1")
    ordered = every.join(shared, "key").groupBy("doc", "n").agg(
        F.sort_array(F.collect_list(F.struct("docs", "key"))).alias("shared"), F.sum("docs").alias("score")
    )
    # Values of one document come first in the prefix.
    left = F.lit(1 - MATCHES) + F.size("shared")
    prefix = ordered.where(left > 0).select(
        "doc", "n", "score", F.slice("shared", F.lit(1), left).getField("key").alias("prefix")
    )
    bits = "aggregate(prefix, 0, (bits, key) -> bits | shiftleft(1, cast(shiftright(key, 32) as int)))"
    return prefix.withColumn("posted", F.expr(bits))


def _similar_sizes(similarity: int):
    return F.expr(f"100 * least(n_a, n_b) >= {similarity} * greatest(n_a, n_b)")


def _agreement(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of posted coordinates in which rows of two signature matrices agree, and all agreements."""
    same = x[:, : 4 * POSTED].copy().view(np.uint32) == y[:, : 4 * POSTED].copy().view(np.uint32)
    rest = (x[:, 4 * POSTED :] == y[:, 4 * POSTED :]).sum(axis=1)
    return same @ (1 << np.arange(POSTED)), same.sum(axis=1) + rest


def _agreeing(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """doc, hub of the pairs whose signatures agree in enough coordinates: the best of each doc."""
    signatures = classes.select("doc", "signature")
    schema = pa.schema([("doc", pa.int64()), ("hub", pa.int64()), ("agree", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, agree = _agreement(*(_matrix(batch.column(i)) for i in (2, 3)))
            keep = pa.array(agree >= LEAST_ESTIMATE * SIGNATURE)
            columns = [batch.column(0), batch.column(1), pa.array(agree, pa.int64())]
            yield to_batch(schema, [c.filter(keep) for c in columns])

    joined = pairs.join(signatures.toDF("doc", "s_a"), "doc").join(signatures.toDF("hub", "s_b"), "hub")
    found = joined.select("doc", "hub", "s_a", "s_b").mapInArrow(run, "doc long, hub long, agree long")
    return found.groupBy("doc").agg(F.max(F.struct("agree", (-F.col("hub")).alias("hub"))).alias("best")).select(
        "doc", (-F.col("best.hub")).alias("hub")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a binary column of one length."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _blocks(
    batches: Iterable[pa.RecordBatch], names: list[str], unpack: Callable
) -> Iterator[tuple[tuple, dict, dict]]:
    """((key, part, slice), stored rows, probing rows) of batches sorted by these and probe.

    Stored rows are those of the whole block, and the same object as long as it lasts; probing
    ones come as the batches cut them. ``unpack`` turns the last column of a batch into an array
    or list. A block that has no stored or no probing rows isn't returned.
    """
    current, waiting, stored = None, [], None
    for batch in batches:
        column = {f: np.asarray(batch.column(i)) for i, f in enumerate(names[:-1])}
        last = unpack(batch.column(len(names) - 1)) if batch.num_rows else []
        change = np.zeros(batch.num_rows, bool)
        for name in names[:4]:
            change[1:] |= column[name][1:] != column[name][:-1]
        cuts = np.flatnonzero(change).tolist()
        for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            if begin == end:
                continue
            place = tuple(int(column[f][begin]) for f in names[:3])
            if place != current:
                current, waiting, stored = place, [], None
            rows = {f: column[f][begin:end] for f in names[4:-1]} | {names[-1]: last[begin:end]}
            if not column["probe"][begin]:
                waiting.append(rows)
            elif waiting or stored:
                if waiting:
                    stored = {f: np.concatenate([w[f] for w in waiting]) for f in names[4:-1]}
                    parts = [w[names[-1]] for w in waiting]
                    whole = isinstance(parts[0], np.ndarray)
                    stored[names[-1]] = np.concatenate(parts) if whole else [v for p in parts for v in p]
                    waiting = []
                yield place, stored, rows


_PLACE = ["key", "part", "slice", "probe"]


def _colliding(mixed: DataFrame, similarity: int) -> DataFrame:
    """The rows of ``mixed`` (without signatures) that have a pair to be confirmed in their block.

    mixed: key, part, slice, probe, doc, n, component, top, posted, signature; ``top`` marks
    documents of the list's largest component.
    """
    schema = pa.schema([
        ("key", pa.int64()), ("part", pa.int32()), ("slice", pa.int32()), ("probe", pa.int32()),
        ("doc", pa.int64()), ("n", pa.int64()), ("component", pa.int64()),
    ])
    names = [*_PLACE, "doc", "n", "component", "top", "posted", "signature"]

    def flagged(place: tuple, probe: int, rows: dict, found: np.ndarray) -> pa.RecordBatch:
        count = int(found.sum())
        fixed = [[v] * count for v in (*place, probe)]
        return to_batch(schema, fixed + [rows[f][found] for f in ("doc", "n", "component")])

    def colliding(key: int, stored: dict, own: dict) -> tuple[np.ndarray, np.ndarray]:
        n, m = own["n"][:, None], stored["n"][None, :]
        # Of two documents outside the largest component the greater one is the one that probes.
        meets = own["top"][:, None] | (own["doc"][:, None] > stored["doc"])
        meets &= own["component"][:, None] != stored["component"]
        i, j = np.nonzero(meets & (100 * np.minimum(n, m) >= similarity * np.maximum(n, m)))
        posted, agree = _agreement(own["signature"][i], stored["signature"][j])
        shared = posted & own["posted"][i] & stored["posted"][j]
        first = (shared & -shared) == 1 << (key >> 32)
        enough = np.bitwise_count(posted) >= MATCHES
        keep = first & enough & (agree >= LEAST_ESTIMATE * SIGNATURE)
        return i[keep], j[keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, place, hit = None, None, None
        for where, stored, probing in _blocks(batches, names, _matrix):
            if stored is not last:
                if last is not None:
                    yield flagged(place, 0, last, hit)
                last, place, hit = stored, where, np.zeros(len(stored["doc"]), bool)
            for at in range(0, len(probing["doc"]), 64):
                own = {f: v[at : at + 64] for f, v in probing.items()}
                i, j = colliding(where[0], stored, own)
                if len(i):
                    hit[j] = True
                    found = np.zeros(len(own["doc"]), bool)
                    found[i] = True
                    yield flagged(where, 1, own, found)
        if last is not None:
            yield flagged(place, 0, last, hit)

    ordered = mixed.repartition("key", "part", "slice").sortWithinPartitions(*_PLACE)
    return ordered.select(*names).mapInArrow(
        run, "key long, part int, slice int, probe int, doc long, n long, component long"
    )


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """doc, n, shingles of texts: sorted distinct hashes as binaries."""
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(words)
        for rows in chunks(batches):
            sets = [signer.shingles(words_of(r[1])) for r in rows]
            yield to_batch(schema, [[r[0] for r in rows], [len(s) for s in sets], [s.tobytes() for s in sets]])

    return texts.select("doc", "text").mapInArrow(run, "doc long, n long, shingles binary")


class _Forest:
    """Components of a block, joined by the links found in it."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, v: int) -> int:
        while (up := self.parent.setdefault(v, v)) != v:
            self.parent[v] = self.parent[up]
            v = self.parent[v]
        return v

    def join(self, a: int, b: int) -> bool:
        """Whether the two were apart."""
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


class _SetIndex:
    """Shingle sets of a block's stored rows: how much of a set each of them holds."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner, self.size = flat[order], owner[order], len(sets)

    def shared(self, own: np.ndarray) -> np.ndarray:
        """Size of the intersection with each stored set."""
        begin = np.searchsorted(self.flat, own, "left")
        length = np.searchsorted(self.flat, own, "right") - begin
        upto = np.cumsum(length)
        places = np.arange(upto[-1] if len(upto) else 0) + np.repeat(begin - upto + length, length)
        return np.bincount(self.owner[places], minlength=self.size)


def _confirm_blocks(colliding: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) that join the components of each block, confirmed on full sets."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = [*_PLACE, "doc", "n", "component", "shingles"]

    def unpack(column: pa.Array) -> list[np.ndarray]:
        return [np.frombuffer(v.as_buffer(), np.uint64) for v in column]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index, forest = None, None, None
        for _, stored, probing in _blocks(batches, names, unpack):
            if stored is not last:
                last, index, forest = stored, _SetIndex(stored["shingles"]), _Forest()
            links = []
            for doc, n, component, own in zip(*(probing[f] for f in names[4:])):
                both = index.shared(own)
                similar = 100 * both >= similarity * (n + stored["n"] - both)
                for j in np.flatnonzero(similar & (stored["doc"] != doc)).tolist():
                    if forest.join(int(component), int(stored["component"][j])):
                        links.append((int(doc), int(stored["doc"][j])))
            if links:
                yield to_batch(schema, list(zip(*links)))

    ordered = colliding.join(sets, ["doc", "n"]).repartition("key", "part", "slice")
    return ordered.sortWithinPartitions(*_PLACE).select(*names).mapInArrow(run, "a long, b long").distinct()


def _confirm(retained: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar."""
    retained = materialize(retained, "minhash-pairs")
    wanted = retained.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    texts = docs.join(wanted, "doc", "left_semi")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def similar(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for rows in chunks(batches, 2):
            found = []
            for a, b, text_a, text_b in ((r[0], r[1], r[3] or "", r[2]) for r in rows):
                if last != (a, text_a):
                    last, last_set = (a, text_a), shingle_set(words_of(text_a), words)
                other = shingle_set(words_of(text_b), words)
                both = len(last_set & other)
                if both and 100 * both >= similarity * (len(last_set) + len(other) - both):
                    found.append((a, b))
            yield to_batch(schema, list(zip(*found)) if found else [[], []])

    joined = (
        retained.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
        .select("a", "b", "text_b", "text_a")
    )
    return joined.mapInArrow(similar, "a long, b long").distinct()


def _mixed_lists(
    postings: DataFrame, components: DataFrame, payload: DataFrame, list_rows: int
) -> DataFrame:
    """Rows of the lists of two or more components, for _colliding.

    Compared with all are the documents outside a list's largest component, in parts of
    about ``list_rows``, fewer long ones; the others meet each part in slices of PROBE_ROWS.
    """
    placed = postings.join(components.withColumnRenamed("node", "doc"), "doc").select(
        "key", "doc", "n", "component"
    )
    sizes = placed.groupBy("key", "component").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")
    )
    top = F.max(F.struct("size", "component", "shingles")).alias("top")
    lists = sizes.groupBy("key").agg(
        top, F.count(F.lit(1)).alias("components"), F.sum("size").alias("size"),
        F.sum("shingles").alias("shingles"),
    ).where("components > 1").select(
        "key", F.col("top.component").alias("top"),
        F.ceil(F.greatest(
            (F.col("size") - F.col("top.size")) / list_rows,
            (F.col("shingles") - F.col("top.shingles")) / LIST_SHINGLES,
        )).cast("int").alias("parts"),
        F.ceil(F.col("size") / PROBE_ROWS).cast("int").alias("slices"),
        (F.col("size") - F.col("top.size") == 1).alias("lone"),
    )

    def own(count: str, seed: int):
        return F.array(F.pmod(F.xxhash64("doc", F.lit(seed)), F.col(count)).cast("int"))

    def every(count: str):
        return F.sequence(F.lit(0), F.col(count) - 1)

    mixed = placed.join(lists, "key").withColumn("top", F.col("component") == F.col("top"))
    stored = mixed.where(~F.col("top")).withColumn("part", F.explode(own("parts", 1))).withColumn(
        "slice", F.explode(every("slices"))
    )
    # A lone document outside the largest component meets that component only.
    probing = mixed.where("top or not lone").withColumn("part", F.explode(every("parts"))).withColumn(
        "slice", F.explode(own("slices", 2))
    )
    both = stored.withColumn("probe", F.lit(0)).unionByName(probing.withColumn("probe", F.lit(1)))
    return both.join(payload, ["doc", "n"])


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    similarity: int = 80,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each document.

    Documents are linked if 100 * intersection >= ``similarity`` * union of their sets of
    distinct ``words``-word shingles; a component is what links reach, named by its smallest
    id, whose row is kept. A text of fewer words has one shingle, all of it; a null text and
    one without words have none and link with nothing. Rows with one doc_id are one node of
    the links. A row with a null id links with nothing: its component is null and it is kept.

    ``similarity`` is in percent, 80 or more: the signature's limits are set for 80.
    """
    if similarity < 80:
        raise ValueError("similarity must be 80 or more")
    described = materialize(describe(docs, key, text, words), "minhash-documents")
    linkable = described.where("n_shingles > 0 and doc_id is not null")
    of_class = linkable.groupBy("digest").agg(F.min("doc_id").alias("doc"))
    classes = linkable.join(of_class, "digest").where("doc_id = doc").select(
        "doc", F.col("n_shingles").alias("n"), "postings", "signature"
    ).dropDuplicates(["doc", "postings"])
    classes = materialize(classes, "minhash-classes")
    prefix = materialize(prefixes(classes), "minhash-prefixes")
    postings = prefix.select("doc", "n", "score", F.explode("prefix").alias("key"))
    texts = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))

    # Every list meets its hub.
    hub = F.max(F.struct("score", (-F.col("doc")).alias("negative"), "doc", "n")).alias("hub")
    star = postings.join(postings.groupBy("key").agg(hub), "key").select(
        "doc", F.col("hub.doc").alias("hub"), F.col("hub.n").alias("n_a"), F.col("n").alias("n_b")
    ).where("doc <> hub").where(_similar_sizes(similarity)).select("doc", "hub").distinct()
    best = _agreeing(star, classes).select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))
    links = materialize(_confirm(best.distinct(), texts, words, similarity), "minhash-links")

    # Then pairs of different components in one list remain.
    nodes = prefix.select(F.col("doc").alias("node")).distinct()
    payload = prefix.select("doc", "n", "posted").join(classes.select("doc", "n", "signature"), ["doc", "n"])
    mixed = _mixed_lists(postings, connected_components(nodes, links, "minhash"), payload, list_rows)
    colliding = materialize(_colliding(mixed, similarity), "minhash-colliding")
    sets = _sets(texts.join(colliding.select("doc").distinct(), "doc", "left_semi"), words)
    more = _confirm_blocks(colliding, sets, similarity)
    links = materialize(links.unionAll(more), "minhash-links")

    # Texts that share an id are one node.
    several = linkable.groupBy("doc_id").agg(
        F.min("digest").alias("x"), F.max("digest").alias("y")
    ).where("x <> y").select("doc_id")
    same = linkable.join(several, "doc_id").join(of_class, "digest").select(
        F.col("doc_id").alias("a"), F.col("doc").alias("b")
    )
    nodes = nodes.unionAll(same.select(F.explode(F.array("a", "b")))).distinct()
    final = connected_components(nodes, links.unionAll(same), "minhash")

    placed = of_class.join(final.withColumnRenamed("node", "doc"), "doc", "left").select(
        "digest", F.coalesce("component", "doc").alias("component")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    with_set = described.where("digest is not null").join(placed, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id")
    )
    without = described.where("digest is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
    )
    return with_set.unionByName(without).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
