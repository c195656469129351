"""Which documents share nearly all their word n-grams: an exact Jaccard join.

1. Documents with the same set of shingles form a class; classes are joined, copies are not.
2. Sets that are alike share a key. From a threshold of PARTS_FROM percent on, a key is a part of a set: two linked sets
   of at most n shingles differ in at most d = 2 * n * (1 - t) / (1 + t) of them, so if the hash order is cut at fixed
   points into more than d parts, one part is the same in both. A part has several shingles, so unlike sets hardly
   ever share one, however many documents there are. Sets of one class of sizes are cut alike; a set also goes by the
   cuts of larger classes that it may have links to. Below that threshold parts would hold too few shingles; there
   they are ordered rarest first, and sets share one of the first n - ceil(t * n) + 1, which are the keys.
3. In the list of a key, pairs pass a length filter, a positional filter (how many common shingles can still lie before
   and behind the shared one) and a suffix filter: the sets are cut at fixed points of the hash order, the sizes of
   the parts are kept modulo 2, and the parts that differ bound the symmetric difference from below. A pair that
   also shares the shingle just before, in both prefixes, met in that list already, where the same filters give the
   same answer; it is not looked at again. So a run of common shingles gives a pair once.
4. What is left is compared once per pair, on the full sets.

A list of m members, all alike, has m * m / 2 links. They are not listed. First each member is compared with the first
one of its list; lists whose members are connected by that are done. In others, a list of over SHORT_LIST members gives at
most m - 1 pairs, which connect what passed its filters. If some of these pairs turn out to be too different, a last round gives every
pair that passed the filters and is not connected yet. So components are exact, and no link between different
components is left out. The number of links of each document, if asked for, comes from all pairs within each component.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinara.llm.common import batches, fixed_array, likely_members, mixed, slices, split_by, stored, texts_of
from opinara.llm.components import components
from opinara.llm.shingles import distinct, shingle_set

#: Least threshold in percent at which parts of sets are the keys.
PARTS_FROM = 75
#: A task sends the keys of equal sets once, as long as it remembers so many.
SEEN = 100_000
#: The order needs only to tell common shingles from rare ones: they are counted in so many buckets.
BUCKET_BITS = 20
#: A prefix list beyond this many members is worked on as pairs of blocks, each by another task.
LIST_BLOCK = 16_384
#: Classes of a component are compared in blocks of so many, all pairs of two blocks at once.
LINK_BLOCK = 256
#: So many different shingles are looked at together there.
LINK_COLUMNS = 4096
#: Lists of up to so many members are worked on together, and give every pair that passes.
SHORT_LIST = 16


def least_overlap(total: int | np.ndarray, percent: int):
    """Common shingles that two sets of together `total` shingles need."""
    return -(-percent * total // (100 + percent))


def rank_order(texts: DataFrame, words: int) -> np.ndarray:
    """By bucket of hash: the number of documents with such shingles, on a logarithmic scale of a byte."""
    def fill(batch, total):
        for part in slices([batch]):
            sets = [shingle_set(t, words) for t in part["text"].to_pylist()]
            at = (np.concatenate(sets) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            total += np.bincount(at, minlength=1 << BUCKET_BITS).astype(np.uint32)

    counts = fixed_array(texts.select("text"), fill, 1 << BUCKET_BITS)
    return np.minimum(255, np.round(8 * np.log2(1.0 + counts))).astype(np.uint8)


def in_order(shingles: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Keys that sort rarest first; 56 bits of the hash break ties and tell shingles apart."""
    rank = ranks[(shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((rank << np.uint64(56)) | (shingles & np.uint64((1 << 56) - 1)))


def parities(shingles: np.ndarray) -> bytes:
    """The suffix filter's part sizes modulo 2, in 512 to 4096 parts; half as many parts come from folding."""
    width = min(4096, max(512, 1 << int(len(shingles) - 1).bit_length()))
    bits = np.bincount((mixed(shingles) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


@lru_cache
def size_classes(percent: int) -> tuple[list[int], list[tuple[int, int, int]]]:
    """The largest size of each class of set sizes; its least size, the parts of its sets, the spare ones among them.

    Of the parts, one more than linked sets can differ in are needed. The spare ones make up for parts that are empty: a set
    with no more empty parts than these has a part in common with each linked set that is not empty.
    """
    largest, cuts, low = [], [], 1
    while low < 1 << 40:
        high = max(low + 1, low * 13 // 10) - 1
        differ = 2 * high * (100 - percent) // (100 + percent)
        parts, least = differ + 1, percent * low / 100
        for _ in range(3):
            empty = parts * (1 - 1 / parts) ** least
            parts = differ + 1 + (math.ceil(empty + 4 * math.sqrt(empty)) if empty > 0.05 else 0)
        largest.append(high)
        cuts.append((low, parts, parts - differ - 1))
        low = high + 1
    return largest, cuts


def part_keys(shingles: np.ndarray, percent: int) -> np.ndarray:
    """One key per part of the set that is not empty, in its class of sizes and in larger ones it may have links to."""
    n = len(shingles)
    sums = np.append(np.uint64(0), np.cumsum(mixed(shingles)))
    largest, cuts = size_classes(percent)
    out = [np.zeros(0, np.uint64)]
    number = bisect_left(largest, n)
    while percent * cuts[number][0] <= 100 * n:
        _, parts, spare = cuts[number]
        if parts - spare > 1:  # else only equal sets are linked
            points = np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts)
            at = np.concatenate([[0], np.searchsorted(shingles, points), [n]])
            keys = mixed(sums[at[1:]] - sums[at[:-1]] + mixed(np.arange(parts, dtype=np.uint64) + np.uint64(number << 32)))
            filled = at[1:] > at[:-1]
            out.append(keys[filled] if parts - filled.sum() <= spare else keys)
        number += 1
    return np.concatenate(out)


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sid(digest: bytes) -> int:
    """The number of a class: 64 bits of the digest of its set."""
    return int.from_bytes(digest[:8], "little", signed=True)


def signatures(texts: DataFrame, words: int) -> DataFrame:
    """Per row: the size of its set, a digest of the set, the number that comes from it, the parities."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("sid", pa.int64()),
                        ("bits", pa.binary())])

    def sign(parts):
        def rows() -> Iterator[dict]:
            for batch in slices(parts):
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                    s = shingle_set(text, words)
                    row = {"doc_id": doc_id, "n": len(s), "digest": b"", "sid": 0, "bits": b""}
                    if len(s) and doc_id is not None:
                        digest = _digest(s)
                        row |= {"digest": digest, "sid": _sid(digest), "bits": parities(s)}
                    yield row
        yield from batches(rows(), schema, 500)

    return texts.mapInArrow(sign, "doc_id long, n long, digest binary, sid long, bits binary")


def postings(texts: DataFrame, words: int, percent: int) -> DataFrame:
    """A row per key of each set: key, sid; for prefixes also the key before it (none where pos is 0) and pos.

    Copies of a set may repeat its rows. Rows without doc_id and empty sets have none.
    """
    prefixes = percent < PARTS_FROM
    held = texts.sparkSession.sparkContext.broadcast(rank_order(texts, words)) if prefixes else None
    names = ["key", "sid", "before", "pos"] if prefixes else ["key", "sid"]

    def spread(parts):
        seen: set[int] = set()
        for batch in slices(parts):
            keys, sids = [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                s = shingle_set(text, words) if doc_id is not None else ()
                if not len(s) or (sid := _sid(_digest(s))) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(sid)
                keys.append(in_order(s, held.value)[:len(s) - -(-percent * len(s) // 100) + 1] if prefixes
                            else part_keys(s, percent))
                sids.append(sid)
            sizes = [len(k) for k in keys]
            if not sum(sizes):
                continue
            every = np.concatenate(keys).view(np.int64)
            columns = [every, np.repeat(np.array(sids, np.int64), sizes)]
            if prefixes:
                columns += [np.append(0, every[:-1]), np.concatenate([np.arange(k, dtype=np.int32) for k in sizes])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return texts.mapInArrow(spread, "key long, sid long" + ", before long, pos int" * prefixes)


def in_lists(posted: DataFrame) -> DataFrame:
    """Rows of `posted` (key, sid) whose key another sid has too, each once; adds the smallest sid with the key."""
    def keep(parts):
        held, known, first = None, False, 0  # the last row, whether its key is shared, the first sid of its list
        for batch in parts:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()[0]
            key, sid = (rows[c].to_numpy() for c in ("key", "sid"))
            new = np.append(True, (key[1:] != key[:-1]) | (sid[1:] != sid[:-1]))
            rows, key, sid = rows.filter(pa.array(new)), key[new], sid[new]
            same = key[1:] == key[:-1]
            shared = np.append(known, same) | np.append(same, False)
            starts = np.flatnonzero(np.append(True, ~same))
            begins = sid[starts]
            if held is not None:
                begins[0] = first
            firsts = np.repeat(begins, np.diff(starts, append=len(key)))
            out = rows.append_column("first", pa.array(firsts))
            last = shared.copy()
            last[-1] = False
            yield out.filter(pa.array(last))
            held, known, first = rows.slice(len(key) - 1), bool(shared[-1]), firsts[-1]
        if known:
            yield held.append_column("first", pa.array([first]))

    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in posted.schema)
    return posted.repartition("key").sortWithinPartitions("key", "sid").mapInArrow(keep, f"{names}, first bigint")


def open_lists(shared: DataFrame, known: DataFrame, sets: DataFrame) -> DataFrame:
    """Members of the lists that are not within one component, for candidate_pairs. known: node, component; sets: sid, n, bits."""
    own = Window.partitionBy("key")
    labelled = (shared.drop("first").join(known.withColumnRenamed("node", "sid"), "sid", "left")
                .withColumn("comp", F.coalesce("component", "sid")).drop("component"))
    mixed_lists = (labelled.withColumn("c", F.count("*").over(own)).withColumn("low", F.min("comp").over(own))
                   .withColumn("high", F.max("comp").over(own)).where("low <> high").drop("low", "high"))
    if "pos" not in shared.columns:
        mixed_lists = mixed_lists.withColumn("before", F.lit(0).cast("long")).withColumn("pos", F.lit(0))
    return mixed_lists.join(sets, "sid")


def _folded(bits: np.ndarray, width: int) -> np.ndarray:
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


class _Lists:
    """Whole prefix lists, one after the other, each ordered by size."""

    def __init__(self, table: pa.Table, percent: int):
        self.percent = percent
        self.sid, self.n, self.pos, self.before, self.comp, self.block, self.cross = (
            table[c].to_numpy().astype(np.int64) for c in ("sid", "n", "pos", "before", "comp", "block", "cross"))
        raw = table["bits"].to_pylist()
        self.width = np.array([len(x) for x in raw]) // 8
        self.bits: dict[int, np.ndarray] = {}
        self.place = np.zeros(len(raw), np.int64)
        for w in np.unique(self.width):
            at = np.flatnonzero(self.width == w)
            self.place[at] = np.arange(len(at))
            self.bits[w] = np.frombuffer(b"".join(raw[i] for i in at), np.uint64).reshape(len(at), w)

    def passing(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of rows (i, j) pass all filters and did not meet in the list before."""
        ok = self.comp[i] != self.comp[j]
        ok &= (self.before[i] != self.before[j]) | (self.pos[i] == 0) | (self.pos[j] == 0)
        ok &= (self.cross[i] == 0) | (self.block[i] != self.block[j])
        ok &= 100 * self.n[j] >= self.percent * self.n[i]
        ok &= 100 * self.n[i] >= self.percent * self.n[j]
        total = self.n[i] + self.n[j]
        room = total - 2 * least_overlap(total, self.percent)
        most = np.minimum(self.pos[i], self.pos[j]) + np.minimum(self.n[i] - self.pos[i], self.n[j] - self.pos[j])
        ok &= 2 * most >= total - room
        left = np.flatnonzero(ok)
        wi, wj = self.width[i[left]], self.width[j[left]]
        for a in np.unique(wi):
            for b in np.unique(wj):
                of = left[(wi == a) & (wj == b)]
                if len(of):
                    x, y = (_folded(self.bits[w][self.place[r[of]]], min(a, b)) for w, r in ((a, i), (b, j)))
                    ok[of] = np.bitwise_count(x ^ y).sum(axis=1) <= room[of]
        return ok

    def pairs(self, starts: np.ndarray, forest: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of sids found in the lists that begin at `starts`; short lists are worked on together."""
        sizes = np.diff(np.append(starts, len(self.sid)))
        number = np.repeat(np.arange(len(starts)), sizes)
        short = np.repeat(sizes <= SHORT_LIST, sizes)
        for gap in range(1, min(SHORT_LIST, sizes.max())):
            i = np.flatnonzero((number[gap:] == number[:-gap]) & short[gap:])
            ok = self.passing(i, i + gap)
            yield self.sid[i[ok]], self.sid[i[ok] + gap]
        for start, size in zip(starts[sizes > SHORT_LIST], sizes[sizes > SHORT_LIST]):
            yield from self._long(start, start + size, forest)

    def _long(self, start: int, stop: int, forest: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        label = np.arange(stop - start)
        for i in range(start + 1, stop):
            least = -(-self.percent * self.n[i] // 100)
            js = np.arange(start + np.searchsorted(self.n[start:i], least), i)
            js = js[self.passing(np.full(len(js), i), js)]
            if forest and len(js):  # one pair for each tree that it connects
                trees, first = np.unique(label[js - start], return_index=True)
                label[np.isin(label, trees)] = label[i - start]
                js = js[first]
            if len(js):
                yield self.sid[js], np.full(len(js), self.sid[i])


def _whole_lists(parts) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole lists and the rows at which the lists begin, from batches sorted by list."""
    held: list[pa.RecordBatch] = []

    def starts(table):
        keys = np.stack([table[c].to_numpy().astype(np.int64) for c in ("key", "p", "q")])
        return np.append(0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1)

    for batch in parts:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        at = starts(table)
        if len(at) == 1:  # one list so far
            held.append(batch)
            continue
        yield table.slice(0, at[-1]), at[:-1]
        held = table.slice(at[-1]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, starts(table)


def candidate_pairs(members: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs (a, b) that pass the filters in some prefix list and belong to different components.

    members: key, before, sid, n, pos, c (length of the list), bits, comp. forest: only pairs that connect.
    """
    blocks = F.ceil(F.col("c") / LIST_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    dealt = (members.withColumn("block", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
             .withColumn("cross", F.col("p") != F.col("q")).drop("other", "c"))

    def find(parts):
        for table, starts in _whole_lists(parts):
            found = [np.stack(p) for p in _Lists(table, percent).pairs(starts, forest)]
            if found:
                a, b = np.concatenate(found, axis=1)
                ends = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in ends], ["a", "b"])

    return (dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "n", "sid")
            .mapInArrow(find, "a long, b long").distinct())


def plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass the filters by length and parities. sets: sid, n, bits."""
    def test(parts):
        for batch in slices(parts, 10_000):
            k = batch.num_rows
            none = np.zeros(2 * k, np.int64)
            rows = {"sid": none, "n": np.concatenate([batch["na"], batch["nb"]]), "comp": np.arange(2 * k),
                    "bits": batch["xa"].to_pylist() + batch["xb"].to_pylist()}
            rows |= dict.fromkeys(("pos", "before", "block", "cross"), none)
            if k:
                ok = _Lists(pa.table(rows), percent).passing(np.arange(k), np.arange(k, 2 * k))
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    for end in "ab":
        pairs = pairs.join(sets.select(F.col("sid").alias(end), F.col("n").alias(f"n{end}"), F.col("bits").alias(f"x{end}")), end)
    return pairs.mapInArrow(test, "a long, b long")


def ends(pairs: DataFrame) -> DataFrame:
    """The sids that occur in pairs (a, b)."""
    return pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Compare each pair (a, b) on the full shingle sets; adds `linked`. texts: sid, text."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])

    def compare(parts):
        def rows():
            for batch in slices(parts):
                for a, b, x, y in zip(*(batch[c].to_pylist() for c in ("a", "b", "x", "y"))):
                    s, t = shingle_set(x, words), shingle_set(y, words)
                    both = len(s) + len(t) - len(distinct(np.concatenate([s, t])))
                    yield {"a": a, "b": b, "linked": 100 * both >= percent * (len(s) + len(t) - both)}
        yield from batches(rows(), schema)

    x, y = (texts.select(F.col("sid").alias(k), F.col("text").alias(v)) for k, v in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(compare, "a long, b long, linked boolean")


def _overlaps(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every set of `x` with every set of `y`."""
    out = np.zeros((len(x), len(y)), np.int64)
    keys = [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in (x, y)]
    rows = [np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (x, y)]
    both = np.intersect1d(distinct(keys[0]), distinct(keys[1]), assume_unique=True)
    if not len(both):
        return out
    held = []
    for k, r in zip(keys, rows):
        at = np.minimum(np.searchsorted(both, k), len(both) - 1)
        hit = both[at] == k
        order = np.argsort(at[hit], kind="stable")
        held.append((at[hit][order], r[hit][order]))
    for start in range(0, len(both), LINK_COLUMNS):
        parts = []
        for (at, r), n in zip(held, out.shape):
            lo, hi = np.searchsorted(at, (start, start + LINK_COLUMNS))
            has = np.zeros((n, min(LINK_COLUMNS, len(both) - start)), np.float32)
            has[r[lo:hi], at[lo:hi] - start] = 1
            parts.append(has)
        out += np.rint(parts[0] @ parts[1].T).astype(np.int64)
    return out


def link_counts(groups: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(sid, links): how many documents of other classes each class is linked to.

    groups: sid, component, docs (documents of the class); texts: sid, text. Linked classes are in one component, so
    within each all pairs of classes are compared on their full sets, in pairs of blocks that go to different tasks. A
    task sends one number per class; pairs are never listed. The comparisons of a component grow with its square.
    """
    sizes = groups.groupBy("component").agg(F.count("*").alias("c")).where("c > 1")
    blocks = F.ceil(F.col("c") / LINK_BLOCK).cast("int")
    dealt = (groups.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("sid"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
             .join(texts, "sid").select(F.col("component").alias("key"), "p", "q", "block", "sid", "docs", "text"))

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        first, second = (table["block"].to_numpy() == table[c].to_numpy() for c in ("p", "q"))
        sid, docs = table["sid"].to_numpy(), table["docs"].to_numpy().astype(np.int64)
        sets = [shingle_set(t, words) for t in table["text"].to_pylist()]
        n = np.array([len(s) for s in sets])
        a, b = np.flatnonzero(first), np.flatnonzero(second)
        both = _overlaps([sets[i] for i in a], [sets[i] for i in b])
        linked = (100 * both >= percent * (n[a][:, None] + n[b][None, :] - both)) & (sid[a][:, None] != sid[b][None, :])
        yield pa.RecordBatch.from_arrays([pa.array(sid[a]), pa.array(linked @ docs[b])], ["sid", "links"])
        if len(table) and not first[b].any():  # two different blocks
            yield pa.RecordBatch.from_arrays([pa.array(sid[b]), pa.array(docs[a] @ linked)], ["sid", "links"])

    def count(parts):
        for table, starts in _whole_lists(parts):
            for lo, hi in zip(starts, np.append(starts[1:], len(table))):
                yield from compare(table.slice(lo, hi - lo))

    return (dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")
            .mapInArrow(count, "sid long, links long").groupBy("sid").agg(F.sum("links").alias("links")))


def near_duplicates(docs: DataFrame, words: int, percent: int, count_links: bool = False) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of `percent` / 100 or more.

    docs: doc_id, text; other columns are ignored. Returns doc_id, n_shingles, class_id (smallest doc_id with
    the same set) and component_id (smallest doc_id reachable by links), one row per row of `docs`.

    A text without words (or null) has an empty set and is alone; repeated rows give repeated results; equal sets are
    one class; count_links adds n_links, the number of other rows with a doc_id that a row is linked to, equal sets
    included (0 for an empty set or without doc_id); a row without doc_id gets its n_shingles, null ids, and links nothing. Rows that repeat a doc_id
    with another text link by each text; all texts of one doc_id should then be read as one document. An empty
    table gives an empty result.
    """
    texts = texts_of(docs)
    signed = stored(signatures(texts, words))
    whole = signed.where("n > 0 and doc_id is not null")
    classes = stored(whole.groupBy("digest").agg(F.min("doc_id").alias("doc_id"),
                                                 *(F.first(c).alias(c) for c in ("n", "sid", "bits"))))
    sets = classes.select("sid", "n", "bits")
    shared = stored(in_lists(postings(texts, words, percent)))

    def compared(pairs: DataFrame) -> DataFrame:
        """Only the texts of classes in some pair are moved."""
        pairs = stored(pairs)
        return stored(verified(pairs, bodies(ends(pairs)), words, percent))

    def bodies(sids: DataFrame) -> DataFrame:
        involved = stored(sids.join(classes.select("sid", "doc_id", "digest"), "sid"))
        return stored(_class_texts(likely_members(texts, involved.select("doc_id")), involved, words))

    firsts = shared.where("first <> sid").select(F.least("first", "sid").alias("a"), F.greatest("first", "sid").alias("b"))
    tried = compared(plausible(firsts.distinct(), sets, percent))
    for forest in (True, False):
        links = tried.where("linked").select("a", "b")
        pairs = stored(candidate_pairs(open_lists(shared, components(links), sets), percent, forest))
        tried = tried.union(compared(pairs.join(tried, ["a", "b"], "left_anti")))
        if pairs.join(tried.where("not linked"), ["a", "b"], "left_semi").isEmpty():
            break
    links = tried.where("linked").select("a", "b")

    found = components(links)
    reps = classes.select("sid", "digest", F.col("doc_id").alias("class_id"))
    named = reps.join(found.withColumnRenamed("node", "sid"), "sid", "left") \
        .withColumn("component", F.coalesce("component", "sid"))
    smallest = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    by_digest = named.join(smallest, "component").select("digest", "class_id", "component_id")
    more_columns = []
    if count_links:
        docs_of = whole.groupBy("digest").agg(F.count("*").alias("docs"))
        linked = found.withColumnRenamed("node", "sid").join(classes.select("sid", "digest"), "sid").join(docs_of, "digest")
        counted = link_counts(linked.select("sid", "component", "docs"), bodies(ends(links)), words, percent)
        per_class = (docs_of.join(classes.select("sid", "digest").join(counted, "sid"), "digest", "left")
                     .select("digest", (F.col("docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
        by_digest = by_digest.join(per_class, "digest")
        more_columns = [F.when(F.col("doc_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links")]
    return (signed.select("doc_id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
            .join(by_digest, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("component_id", "doc_id").alias("component_id"), *more_columns))


def one_of_each(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Rows of `docs` that stay, all columns unchanged: of each component the document with the smallest doc_id."""
    gone = stored(near_duplicates(docs, words, percent).where("doc_id <> component_id").select("doc_id").distinct())
    maybe, others = split_by(docs, gone)
    return maybe.join(gone, "doc_id", "left_anti").select(docs.columns).union(others)


def _class_texts(texts: DataFrame, involved: DataFrame, words: int) -> DataFrame:
    """(sid, text) of each class in `involved` (sid, doc_id, digest): the text of its doc_id that has its digest.

    The join shuffles even few rows: `texts` may come out of a Python filter, and two Python steps in one stage take two
    workers per core, which stay and learn as much as others in later stages.
    """
    def check(parts):
        for batch in slices(parts):
            same = [_digest(shingle_set(t, words)) == d
                    for t, d in zip(batch["text"].to_pylist(), batch["digest"].to_pylist())]
            yield batch.select(["sid", "text"]).filter(pa.array(same, pa.bool_()))

    return (texts.join(involved.hint("merge"), "doc_id").select("sid", "text", "digest")
            .mapInArrow(check, "sid long, text binary").dropDuplicates(["sid"]))
