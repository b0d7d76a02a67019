"""Documents with nearly the same word n-grams: an exact Jaccard join over parity sketches.

A document's set is its distinct word n-grams, as 64-bit hashes. Two sets a, b link when
share_of * |a & b| >= share * |a | b|, so their symmetric difference has at most
D = (share_of - share) * (|a| + |b|) / (share_of + share) members.

* Parity sketch: the space of hashes is cut into groups, and each group keeps the XOR of the
  hashes that a set has in it. Every member of the symmetric difference changes one group, so
  the number of groups that differ never exceeds the symmetric difference.
* Pigeonhole: of G > D groups at least G - D are equal in two sets that link. Sets of like size
  share a band; within a band all sets use the same G, and a linked pair meets in a group with
  the same content. G leaves a margin of ``spare`` groups for empty ones: a set with no more empty
  groups than that meets its partners in a group with content. Only sets with more, which are
  rare, also use their empty groups, and meet in them only one another.
* Buckets: sets with one group in common form a bucket. Not all its pairs are formed. Round one
  compares each set with the bucket's smallest one; verified links give components. Round two
  takes, in the buckets that still hold several components, the nearest pairs that would join all that
  may belong together. Round three gathers the sets of all pairs that are left, by the chains that
  these form, and tests them where they meet: only links that join two components leave the task.
  A pair within a component needs no test: it cannot change the result.
* Bit sketches (one bit toggled for each member) bound the symmetric difference from below and
  rule out almost all pairs that do not link; the others are verified on their whole sets.

Sets are named by a 64-bit hash of all their members; equal sets are one node from the start.
Before the shuffle each batch reduces a group that several of its sets share to the smallest
set, so a group of copies with a third of all rows sends a row per batch and key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import free_name, give_back, mix64, read_table, shingle_hashes, split_words, texts_of, tidied, word_codes, word_hashes
from tidemark.llm.components import bloom_of, components
from tidemark.llm.token_ids import parts_of
from tidemark.session import settle

SIZE = 4
SHARE, SHARE_OF = 85, 100
#: Rows of one block of a large bucket.
BLOCK = 1024
#: Group rows that one task sorts, and bytes of text that make one; they set the number of shuffle partitions for large inputs.
TASK_ROWS, GROUP_BYTES = 1 << 21, 16
#: Marks the meeting of a bucket's largest component with the others.
OTHERS = -(1 << 40)
#: Bytes of sketches or sets that one task compares.
PART_BYTES = 16 << 20
#: Rows that are compared at once, and with how many of those behind them.
AT_ONCE, STEPS = 1 << 14, 32
#: Bytes of text whose sets are made at a time.
PIECE_BYTES = 8 << 20
SEPARATOR = np.uint64(0xA0761D6478BD642F)


class Bands:
    """Sizes of sets in bands, so that linked sets are in the same band or in neighbouring ones."""

    def __init__(self, share: int, share_of: int, largest: int = 1 << 40):
        self.share, self.share_of = share, share_of
        bounds = [1]
        while bounds[-1] <= largest:
            bounds.append(bounds[-1] * share_of // share + 1)
        self.bounds = np.array(bounds, np.int64)
        most = self.bounds[1:] - 1  # the largest size of each band
        self.differ = self.most_apart(most, most)
        spare = np.zeros(len(most), np.int64)
        low = np.concatenate(([1], self.bounds[:-2]))  # the smallest size that uses a band's groups
        for _ in range(8):
            groups = self.differ + 1 + spare
            empty = groups * np.exp(-low / groups)
            spare = np.where(self.differ == 0, 0, np.minimum(np.ceil(empty + 3 * np.sqrt(empty)), self.differ + 1)).astype(np.int64)
        self.spare, self.groups = spare, self.differ + 1 + spare

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, sizes, side="right") - 1

    def most_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest symmetric difference of sets of these sizes that link."""
        return (self.share_of - self.share) * (a + b) // (self.share_of + self.share)

    def links(self, common: int, a: int, b: int) -> bool:
        return self.share_of * common >= self.share * (a + b - common)


class Sets:
    """The sets of a batch of texts: all members one after another, in order within each set."""

    def __init__(self, texts: pa.Array, size: int = SIZE):
        words, starts = split_words(pc.ascii_lower(texts))
        codes, distinct = word_codes(words)
        hashes = word_hashes(distinct)[codes]
        members, at = shingle_hashes(hashes, starts, size)
        owner = np.searchsorted(starts, at, side="right") - 1
        short = np.flatnonzero((np.diff(starts) > 0) & (np.diff(starts) < size))
        whole = [_whole(hashes[starts[k] : starts[k + 1]]) for k in short.tolist()]
        members = np.concatenate([members, np.array(whole, np.uint64)])
        owner = np.concatenate([owner, short])
        order = np.lexsort((members, owner))
        members, owner = members[order], owner[order]
        new = np.ones(len(members), bool)
        new[1:] = (members[1:] != members[:-1]) | (owner[1:] != owner[:-1])
        self.members, self.owner = members[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(texts)).astype(np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))
        mixed = mix64(self.members ^ SEPARATOR)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)))
        sums = total[self.starts[1:]] - total[self.starts[:-1]]
        parity = np.concatenate((np.zeros(1, np.uint64), np.bitwise_xor.accumulate(self.members)))
        parities = parity[self.starts[1:]] ^ parity[self.starts[:-1]]
        self.names = mix64(sums + mix64(parities + self.sizes.astype(np.uint64))).view(np.int64)

    def of(self, k: int) -> np.ndarray:
        return self.members[self.starts[k] : self.starts[k + 1]]

    def sketch(self, k: int) -> bytes:
        """Bits toggled by the members; a power of two of at least twice as many bits, folded for a smaller set."""
        bits = 64
        while bits < 2 * self.sizes[k]:
            bits *= 2
        return np.packbits(np.bincount((mix64(self.of(k)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1, bitorder="little").tobytes()


def _whole(hashes: np.ndarray) -> int:
    """One hash for a text of fewer words than a shingle has."""
    total = np.array([SEPARATOR], np.uint64)
    for h in hashes:
        total = mix64(total + h)
    return int(total[0])


def group_keys(sets: Sets, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(key, name of the set) of all groups that the sets of a batch share with others, in both their bands."""
    keys, names = [], []
    pattern = mix64(sets.members + np.uint64(1))
    filled = np.flatnonzero(sets.sizes)
    band = np.zeros(len(sets.sizes), np.int64)
    band[filled] = bands.of(sets.sizes[filled])
    for shift in (0, 1):  # its own band, and the next one, as the smaller of a pair
        level = (band + shift)[sets.owner]
        groups = bands.groups[level].astype(np.uint64)
        group = ((sets.members >> np.uint64(32)) * groups) >> np.uint64(32)
        if not len(group):
            continue
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (sets.owner[1:] != sets.owner[:-1])
        begins = np.flatnonzero(new)
        content = np.bitwise_xor.reduceat(pattern, begins)
        owner = sets.owner[begins]
        place = level[begins].astype(np.uint64) << np.uint64(40) | group[begins]
        keys.append(mix64(content + mix64(place)))
        names.append(sets.names[owner])
        used = np.bincount(owner, minlength=len(sets.sizes))
        many = filled[(bands.groups - bands.spare)[band[filled] + shift] > used[filled]]
        for k in many.tolist():  # more empty groups than the margin
            own = band[k] + shift
            first, behind = np.searchsorted(owner, (k, k + 1))
            empty = np.setdiff1d(np.arange(bands.groups[own]), group[begins[first:behind]].astype(np.int64))
            place = np.uint64(own) << np.uint64(40) | empty.astype(np.uint64)
            keys.append(mix64(mix64(place) ^ SEPARATOR))
            names.append(np.full(len(empty), sets.names[k]))
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(names)


def _runs(keys: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, name) in order: keys, names, the run each belongs to, where each run begins."""
    order = np.lexsort((names, keys))
    keys, names = keys[order], names[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])
    keys, names = keys[new], names[new]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    begins = np.flatnonzero(first)
    return keys, names, np.cumsum(first) - 1, begins


def _pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of different names."""
    both = np.unique(np.stack([a, b], axis=1)[a != b], axis=0) if len(a) else np.zeros((0, 2), np.int64)
    return both[:, 0], both[:, 1]


_SEND, _PAIRS, _MEMBERS, _TEXTS = 0, 1, 2, 3
_SENT = [("part", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("names", pa.binary()), ("more", pa.binary())]
_TOLD = [("a", pa.int64()), ("mark", pa.int64()), ("row_key", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary())]
_TOLD_SQL = "a long, mark long, row_key long, n long, sketch binary"


def _filled(columns: dict[str, pa.Array], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    """A batch with these fields in order; those without a column are NULL."""
    n = len(next(iter(columns.values())))
    arrays = [columns[name].cast(kind) if name in columns else pa.nulls(n, kind) for name, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _grouped(texts: DataFrame, bands: Bands, size: int, parts: int) -> DataFrame:
    """One pass over ``texts`` (text, row_key, mark, doc_id) and one shuffle, which give rows of three kinds:

    kind 1 (a, b): b is to be compared with a, its bucket's smallest set; kind 2 (key in b, set in a): the members of a
    bucket of more than two sets; kind 3: a text with its set's name (a), size and sketch. Texts are read whole.
    """
    id_type = to_arrow_type(texts.schema["doc_id"].dataType)
    sent_fields, out_fields = [*_SENT, *_TOLD, ("doc_id", id_type)], [("kind", pa.int32()), ("b", pa.int64()), *_TOLD, ("doc_id", id_type)]
    id_sql = f"doc_id {dict(texts.dtypes)['doc_id']}"

    def told(piece: pa.RecordBatch, sets: Sets) -> pa.RecordBatch:
        n = len(sets.sizes)
        sketches = pa.array([sets.sketch(k) if sets.sizes[k] else None for k in range(n)], pa.binary())
        columns = {
            "part": pa.array((np.arange(n) + int(sets.names[0])) % parts), "kind": pa.array(np.full(n, _TEXTS)), "a": pa.array(sets.names),
            "mark": piece.column(2), "row_key": piece.column(1), "n": pa.array(sets.sizes), "sketch": sketches, "doc_id": piece.column(3),
        }
        return _filled(columns, sent_fields)

    @tidied
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (piece for whole in batches for piece in parts_of(whole, 0, PIECE_BYTES)):
            sets = Sets(texts_of(piece.column(0)), size)
            yield told(piece, sets)
            keys, names, run, begins = _runs(*group_keys(sets, bands))
            if not len(keys):
                continue
            lengths = np.diff(np.append(begins, len(keys)))
            shared = (lengths > 1)[run]
            a, b = _pairs(names[begins][run[shared]], names[shared])
            part = (keys[begins] % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            heads, crowded = begins[order], (lengths[order] > 1).astype(np.uint8)
            cuts = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
            rows = [
                (p, _SEND, keys[heads[s:e]].tobytes(), names[heads[s:e]].tobytes(), crowded[s:e].tobytes())
                for p, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s
            ]
            # What is settled within the batch passes through the same shuffle, spread over its tasks.
            own = int(names[0]) % parts
            if len(a):
                rows.append((own, _PAIRS, a.tobytes(), b.tobytes(), b""))
                rows.append((own, _MEMBERS, names[shared].tobytes(), keys[shared].tobytes(), b""))
            yield _filled({name: pa.array(c, kind) for (name, kind), c in zip(_SENT, zip(*rows))}, sent_fields)

    def met(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent_keys, sent_names, sent_more = [], [], []

        def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            columns = {"kind": pa.array(np.full(len(a), kind)), "a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))}
            return _filled(columns, out_fields)

        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            texts = batch.filter(pa.array(kinds == _TEXTS))
            if texts.num_rows:
                yield _filled({name: texts.column(name) for name, _ in out_fields if name in texts.schema.names}, out_fields)
            for at in np.flatnonzero(kinds != _TEXTS).tolist():
                x, y = (np.frombuffer(batch.column(c)[at].as_py(), np.int64) for c in ("keys", "names"))
                if kinds[at] == _SEND:
                    sent_keys.append(x.view(np.uint64))
                    sent_names.append(y)
                    sent_more.append(np.frombuffer(batch.column("more")[at].as_py(), np.uint8))
                else:
                    yield out(int(kinds[at]), x, y)
        if not sent_keys:
            return
        keys, names, more = (np.concatenate(x) for x in (sent_keys, sent_names, sent_more))
        order = np.argsort(keys, kind="stable")
        keys, names, more = keys[order], names[order], more[order]
        twice = np.zeros(len(keys), bool)
        twice[1:] = keys[1:] == keys[:-1]
        twice[:-1] |= twice[1:]
        keys, names, more = keys[twice], names[twice], more[twice]
        with_more = np.unique(keys[more > 0])
        keys, names, run, begins = _runs(keys, names)
        if not len(keys):
            return
        lengths = np.diff(np.append(begins, len(keys)))
        yield out(_PAIRS, *_pairs(names[begins][run], names))
        large = (lengths > 2) | (lengths > 1) & np.isin(keys[begins], with_more)
        yield out(_MEMBERS, names[large[run]], keys[large[run]])
        give_back()

    blobs = texts.select("text", "row_key", "mark", "doc_id").mapInArrow(
        sent, f"part int, kind int, keys binary, names binary, more binary, {_TOLD_SQL}, {id_sql}"
    )
    return blobs.groupBy("part").applyInArrow(met, f"kind int, b long, {_TOLD_SQL}, {id_sql}")


def fold_to(sketch: bytes, words: int) -> np.ndarray:
    """A sketch folded to so many 64-bit words: halves are XORed, which keeps the bound."""
    data = np.frombuffer(sketch, np.uint64)
    while len(data) > words:
        data = data[: len(data) // 2] ^ data[len(data) // 2 :]
    return data


def _apart(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference."""
    words = min(len(a), len(b)) // 8
    return int(np.bitwise_count(fold_to(a, words) ^ fold_to(b, words)).sum())


def _possible(pairs: DataFrame, nodes: DataFrame, bands: Bands) -> DataFrame:
    """Pairs (a, b) that their sizes and bit sketches allow to link, with ``apart``, a bound of their difference."""
    left = nodes.select(F.col("name").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = nodes.select(F.col("name").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    sized = pairs.join(left, "a").join(right, "b").where(
        (F.col("n_a") * bands.share_of >= F.col("n_b") * bands.share) & (F.col("n_b") * bands.share_of >= F.col("n_a") * bands.share)
    )

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                apart = np.array([_apart(x, y) for x, y in zip(batch.column("s_a").to_pylist(), batch.column("s_b").to_pylist())], np.int64)
                kept = pa.array(apart <= bands.most_apart(n_a, n_b))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(apart)], names=["a", "b", "apart"]).filter(kept)

    return sized.mapInArrow(run, "a long, b long, apart long")


def _close_pairs(rows: dict[str, np.ndarray], sketches: list[bytes], bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, apart) of all rows of one bucket and different components that sizes and bit sketches allow to link.

    ``rows`` are in order of their buckets. Row i meets rows i + 1 to i + ``STEPS``, then the next so
    many, for all buckets at once; two blocks of a large bucket meet only each other.
    """
    bucket, label, n, block, mixed = (rows[c] for c in ("bucket", "label", "n", "block", "mixed"))
    words = np.array([len(s) // 8 for s in sketches], np.int64)
    begins = np.cumsum(words) - words
    flat = np.frombuffer(b"".join(sketches), np.uint64)

    def matrix(of: np.ndarray, to: int) -> np.ndarray:
        """Sketches of these rows, all as long, folded to ``to`` words."""
        data = flat[begins[of][:, None] + np.arange(words[of[0]])]
        while data.shape[1] > to:
            half = data.shape[1] // 2
            data = data[:, :half] ^ data[:, half:]
        return data

    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ends = np.searchsorted(bucket, bucket, side="right")
    first = 1
    left = np.flatnonzero(ends - np.arange(len(bucket)) > first)
    while len(left):
        for at in range(0, len(left), AT_ONCE):
            own = left[at : at + AT_ONCE]
            i, j = np.repeat(own, STEPS), (own[:, None] + np.arange(first, first + STEPS)).ravel()
            inside = j < ends[i]
            i, j = i[inside], j[inside]
            small, big = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            meet = (label[i] != label[j]) & (small * bands.share_of >= big * bands.share) & (~mixed[i] | (block[i] != block[j]))
            i, j = i[meet], j[meet]
            for sizes in np.unique(np.stack([words[i], words[j]], axis=1), axis=0) if len(i) else ():
                alike = np.flatnonzero((words[i] == sizes[0]) & (words[j] == sizes[1]))
                to = int(sizes.min())
                most = max(1, (1 << 21) // int(sizes.max()))
                for part in range(0, len(alike), most):
                    x, y = i[alike[part : part + most]], j[alike[part : part + most]]
                    apart = np.bitwise_count(matrix(x, to) ^ matrix(y, to)).sum(axis=1).astype(np.int64)
                    hit = apart <= bands.most_apart(n[x], n[y])
                    found.append((x[hit], y[hit], apart[hit]))
        first += STEPS
        left = left[ends[left] - left > first]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found))


def _spread(named: DataFrame) -> DataFrame:
    """Rows (key, name, label) of buckets that hold several labels, as (key, low, high, block, name, label): what is to meet has the same first three.

    Of buckets with the same sets one is kept. A bucket of more than ``BLOCK`` sets is cut: the sets of its largest
    component need only meet those of others, so each of them goes to one block, and the others to all these blocks;
    the others are cut into blocks of which any two meet. Two blocks meet only each other.
    """
    mark = lambda k: F.sum(F.pmod(F.xxhash64("name", F.lit(k)), F.lit(1 << 31)))
    several = named.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("label").alias("lo"), F.max("label").alias("hi"), *[mark(k).alias(f"m{k}") for k in range(3)]
    ).where("lo <> hi")
    kept = settle(several.groupBy("n_rows", "m0", "m1", "m2").agg(F.min("key").alias("key")).select("key", "n_rows"), "several")
    rows = settle(named.join(kept, "key"), "held")
    small = rows.where(F.col("n_rows") <= BLOCK).select(
        "key", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("block"), "name", "label"
    )
    large = rows.where(F.col("n_rows") > BLOCK)
    counts = large.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n_main"))
    main = counts.groupBy("key").agg(F.max(F.struct("n_main", "label")).alias("main"))
    blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("long")
    meeting = lambda low, high, block: F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"), block.cast("long").alias("block"))
    n_main, n_others = blocks(F.col("main.n_main")), blocks(F.col("n_rows") - F.col("main.n_main"))
    in_main, in_others = F.pmod(F.xxhash64("name"), n_main), F.pmod(F.xxhash64("name"), n_others)
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    others = F.concat(
        F.transform(numbers(n_main), lambda b: meeting(-1 - b, F.lit(OTHERS), F.lit(1))),
        F.transform(numbers(n_others), lambda b: meeting(F.least(b, in_others), F.greatest(b, in_others), in_others)),
    )
    places = F.when(F.col("label") == F.col("main.label"), F.array(meeting(-1 - in_main, F.lit(OTHERS), F.lit(0)))).otherwise(others)
    cut = large.join(main, "key").select("key", "name", "label", F.explode(places).alias("at"))
    return small.unionByName(cut.select("key", "at.low", "at.high", "at.block", "name", "label"))


def _candidates(table: pa.Table, bands: Bands) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """(columns of a task's rows, pairs of rows (i, j) that may link and are of different components, the nearest first)."""
    rows = {c: table.column(c).to_numpy() for c in ("key", "low", "high", "block", "name", "label", "n")}
    order = np.lexsort((rows["name"], rows["high"], rows["low"], rows["key"]))
    rows = {c: x[order] for c, x in rows.items()} | {"order": order}
    new = np.zeros(len(order), bool)
    for c in ("key", "low", "high"):
        new[1:] |= rows[c][1:] != rows[c][:-1]
    rows |= {"bucket": np.cumsum(new), "mixed": rows["low"] != rows["high"]}
    i, j, apart = _close_pairs(rows, table.column("sketch").take(pa.array(order)).to_pylist(), bands)
    nearest = np.lexsort((rows["name"][j], rows["name"][i], apart))
    return rows, i[nearest], j[nearest]


class _Union:
    """Which numbers have been joined."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether they were apart; now they are joined."""
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def _table(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _dealt(spread: DataFrame, bytes_of: F.Column) -> DataFrame:
    """Written rows with ``part``: what meets is in one part, and parts hold about ``PART_BYTES``."""
    size = spread.agg(F.sum(bytes_of + 64)).first()[0] or 0
    parts = max(int(spread.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES)
    return spread.withColumn("part", F.pmod(F.xxhash64("key", "low", "high"), F.lit(parts)))


def _across(members: DataFrame, labels: DataFrame, nodes: DataFrame, bands: Bands, joined: str) -> DataFrame:
    """Pairs of one bucket but different components that sizes and bit sketches allow to link: as many as it takes to
    join what they can join, the nearest first. A task sends fewer pairs than it holds sets.

    ``joined`` is what a pair joins: "label", the components, or "name", the sets, so that every set of any such pair is in one.
    """
    named = members.join(labels, F.col("name") == F.col("node"), "left").select("key", "name", F.coalesce("label", "name").alias("label"))
    spread = settle(_spread(named).join(nodes.select("name", "n", "sketch"), "name"), "spread")

    def compared(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows, i, j = _candidates(table, bands)
        union, names, ends = _Union(), rows["name"], rows[joined]
        kept = [k for k, (x, y) in enumerate(zip(ends[i].tolist(), ends[j].tolist())) if union.join(x, y)]
        a, b = names[i[kept]], names[j[kept]]
        give_back()
        return _table(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())

    return _dealt(spread, F.octet_length("sketch")).groupBy("part").applyInArrow(compared, "a long, b long")


def _links_within(pairs: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, bands: Bands, size: int) -> DataFrame:
    """The links that join components, among sets that ``pairs`` connect: found on the whole sets, where these meet.

    Sets that chains of pairs connect form a bucket. A task sends a link only if it joins two components it has not joined before.
    """
    near = components(pairs).select("node", F.col("label").alias("key"))
    named = near.withColumnRenamed("node", "name").join(labels.withColumnRenamed("node", "name"), "name", "left")
    named = named.select("key", "name", F.coalesce("label", "name").alias("label"))
    sets = _sets_of(named.select("name").distinct(), nodes, texts, size)
    spread = settle(_spread(named).join(nodes.select("name", "n", "sketch"), "name").join(sets, "name"), "spread")

    def linked(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows, i, j = _candidates(table, bands)
        sets = table.column("members").take(pa.array(rows["order"]))
        of = lambda k: np.frombuffer(sets[k].as_buffer(), np.uint64)
        union, a, b = _Union(), [], []
        names, label = rows["name"].tolist(), rows["label"].tolist()
        for x, y in zip(i.tolist(), j.tolist()):
            if union.root(label[x]) != union.root(label[y]):
                own, other = of(x), of(y)
                if bands.links(len(np.intersect1d(own, other, assume_unique=True)), len(own), len(other)):
                    union.join(label[x], label[y])
                    a.append(min(names[x], names[y]))
                    b.append(max(names[x], names[y]))
        give_back()
        return _table(a, b)

    return _dealt(spread, F.octet_length("members") + F.octet_length("sketch")).groupBy("part").applyInArrow(linked, "a long, b long")


def _of_two(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose sets are in different components."""
    label_of = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
    both = pairs.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left")
    return both.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")


def _sets_of(wanted: DataFrame, nodes: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(name, members) of the sets in ``wanted`` (name). Sets are made again from the texts of one document each."""
    chosen = settle(nodes.join(wanted, "name", "left_semi").select("row_key"), "chosen")
    shared = nodes.sparkSession.sparkContext.broadcast(bloom_of(chosen, "row_key"))

    @tidied
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                batch = batch.filter(pa.array(shared.value.test(batch.column(1).to_numpy())))
            for piece in parts_of(batch, 0, PIECE_BYTES):
                made = Sets(texts_of(piece.column(0)), size)
                name, kept = np.unique(made.names, return_index=True)
                blobs = pa.array([made.of(k).tobytes() for k in kept.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(name), blobs], names=["name", "members"])

    return settle(texts.mapInArrow(sets, "name long, members binary").join(wanted, "name", "left_semi"), "sets")


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, bands: Bands, size: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link. Sets are made again from the texts of one document each."""
    wanted = pairs.select(F.col("a").alias("name")).unionByName(pairs.select(F.col("b").alias("name"))).distinct()
    members = _sets_of(wanted, nodes, texts, size)

    @tidied
    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("m_a"), batch.column("m_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                kept.append(bands.links(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    right = members.select(F.col("name").alias("b"), F.col("members").alias("m_b"))
    left = members.select(F.col("name").alias("a"), F.col("members").alias("m_a"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").mapInArrow(tested, "a long, b long")


def near_groups(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE, share: int = SHARE, share_of: int = SHARE_OF
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id reachable by links, its own included).

    NULL and empty texts, and texts of white space, have no shingle and link with nothing; their
    component is their own id. Rows with the same id are documents of their own. A NULL id never
    is a component's smallest unless all are NULL. Empty input gives an empty result.
    """
    rows = _component_rows(df, id_col, text, size, share, share_of)
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _component_rows(df: DataFrame, id_col: str, text: str, size: int, share: int, share_of: int) -> DataFrame:
    """doc_id, mark (a hash of the text), n, component_id and first_mark (of the row that stays) of each document."""
    spark, bands = df.sparkSession, Bands(share, share_of)
    # A number for each document by which the texts of chosen ones are found again; equal ones only mean more texts.
    key = F.when(F.col(id_col).isNull(), F.xxhash64(F.col(text))).otherwise(F.xxhash64(F.col(id_col)))
    texts = df.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), key.alias("row_key"), F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text)).alias("mark")
    )
    size_of_all = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size_of_all // (GROUP_BYTES * TASK_ROWS))
    told = settle(_grouped(texts, bands, size, parts), "buckets")
    rows = told.where(F.col("kind") == _TEXTS).select("doc_id", "mark", "row_key", "n", F.col("a").alias("name"), "sketch")
    filled = rows.where("n > 0")
    one = [F.first(c).alias(c) for c in ("n", "sketch")]
    nodes = settle(filled.groupBy("name").agg(*one, F.min("row_key").alias("row_key")), "nodes")
    starred = told.where(F.col("kind") == _PAIRS).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    members = told.where(F.col("kind") == _MEMBERS).select(F.col("b").alias("key"), F.col("a").alias("name"))
    possible = settle(_possible(starred, nodes, bands), "possible")
    plain = texts.select("text", "row_key")
    # Round one: each set with the one that seems nearest of those it was compared with.
    tested = settle(possible.groupBy("b").agg(F.min_by("a", F.struct("apart", "a")).alias("a")).select("a", "b"), "tested")
    links = settle(_verified(tested, nodes, plain, bands, size), "linked")
    # These links are trees; two steps towards the roots are enough to tell most of them apart in round two.
    up = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
    further = up.select(F.col("node").alias("label"), F.col("label").alias("next"))
    labels = settle(up.join(further, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
    # Round two: the nearest pairs that would join all components that may belong together.
    new = _across(members, labels, nodes, bands, "label").unionByName(possible.select("a", "b")).distinct()
    new = settle(_of_two(new, labels).join(tested, ["a", "b"], "left_anti"), "tested")
    links = links.unionByName(settle(_verified(new, nodes, plain, bands, size), "linked"))
    labels = settle(components(links), "labels")
    # Round three: what may still join two components meets with its whole sets.
    left = settle(_across(members, labels, nodes, bands, "name").distinct(), "left")
    more = settle(_links_within(left, labels, nodes, plain, bands, size), "linked")
    if not more.isEmpty():
        labels = settle(components(links.unionByName(more)), "labels")
    named = rows.join(labels, (F.col("name") == F.col("node")) & (F.col("n") > 0), "left").select(
        "doc_id", "mark", "n", F.when(F.col("n") > 0, F.coalesce("label", "name")).alias("label")
    )
    smallest = named.where(F.col("label").isNotNull()).groupBy(F.col("label").alias("of")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")).alias("first")
    )
    return named.join(smallest, F.col("label") == F.col("of"), "left").select(
        "doc_id", "mark", "n", F.when(F.col("n") > 0, F.col("first.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("first.mark").alias("first_mark"),
    )


def drop_near_copies(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", size: int = SIZE, share: int = SHARE, share_of: int = SHARE_OF
) -> DataFrame:
    """The rows of ``df`` that stay, with their columns: of each component the one with the smallest id.

    Texts without a word all stay. Of rows with the same id, that with the smallest hash of its
    text; of rows with the same id and text one.
    """
    rows = settle(_component_rows(df, id_col, text, size, share, share_of).where("n > 0"), "components")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("mark") == F.col("first_mark"))
    own, mark = free_name(df, "id"), free_name(df, "mark")
    gone = rows.where(~first).select(F.col("doc_id").alias(own), F.col("mark").alias(mark)).distinct()
    same = F.col(id_col).eqNullSafe(F.col(own)) & (F.xxhash64(F.col(text)) == F.col(mark))
    left = df.join(gone, same, "left_anti")
    again = rows.where(first).groupBy(F.col("doc_id").alias(own), F.col("mark").alias(mark)).count().where("count > 1").drop("count")
    if again.isEmpty():
        return left
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates([id_col, text]))


def op5_parity_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read_table(spark, sf_dir, "documents"))


QUERIES = {"op5_parity_jaccard": op5_parity_jaccard}
ORACLE_SQL: dict[str, str] = {}
