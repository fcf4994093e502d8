"""Benchmark decontamination by latent semantic retrieval.

Items of the benchmark are the passages of a TF-IDF matrix whose word weights come from the counts
of all documents.  A randomised SVD of this matrix, its products summed by Spark over blocks of
passages, gives a latent space of ``RANK`` dimensions, however many items there are.

A document's regions begin every few words and are somewhat longer than the item, by how much
follows from the item's length (``length_class``).  Folded into the space, a region is a candidate
when its cosine with an item reaches ``COSINE``.  Before that, each word carries the most it can add
to a verified copy of any item; regions whose words together cannot reach a verified copy are not
folded, which loses nothing.

Each candidate is then verified on words: the longest common subsequence of the item and the region
must cover ``SAME`` of the item, or ``LIKE`` of it when the region holds the item's answer, its
last ``ANSWER`` words, as a subsequence too.

Copies word for word do not depend on a cosine: beside the search, each place of an item's rarest
pair of neighbouring words is compared with the whole item.  Items of fewer than ``LEAST_WORDS``
words are found in this way only.

The benchmark is a stated, bounded set of queries.  The documents are read once into word numbers
and searched once, for all items together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import ROW, stage, text_of, with_row_key

RANK = 128
COSINE = 0.4
SPARE = 16
SAME = 0.8
LIKE = 0.6
ANSWER = 5
LEAST_WORDS = 5
_ROWS = 2000
_CHUNK = 256
_MEMBERS = 32
_BITS = 256
# Documents begin at multiples of the longest stride, so that regions of any class begin there too.
_LONGEST_STRIDE = 64
# Words searched at a time, a multiple of the longest stride, and words of documents taken together.
_WORDS = 1 << 14
_TOGETHER = 1 << 19
# ASCII letters and digits, and all that is not ASCII, make words.
_TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_TO_SPACE).split()


def length_class(n: int) -> int:
    """``n`` or somewhat more; items of one class share their regions."""
    step = _step(n)
    return -(-n // step) * step


def _step(n: int) -> int:
    return max(4, 1 << max(n.bit_length() - 3, 0))


# --- the benchmark as a latent space ---------------------------------------------------


@dataclass
class Index:
    """Benchmark items in the latent space.

    ``vocabulary``: word to number.  ``space``: words by dimensions, weighted; the last row, zero,
    is that of words outside.  ``latent``: one row per item, divided by the least product of a
    verified copy.  ``most``: the most a word adds to a full product with any of them, in shares of
    that least.  ``items``: id and word numbers of each item, short ones last.  ``classes``: words of a region, words between regions, some items of
    one class, and ``most`` for them alone.
    ``anchors``: sorted pairs of words, and for each pair the items (with the pair's place in it)
    that it is the rarest of; ``starts``: whether a word begins such a pair.  ``marks``: words of each
    searched item by number modulo ``_BITS``; ``sizes``: its length.
    """

    vocabulary: dict[bytes, int]
    space: np.ndarray
    latent: np.ndarray
    most: np.ndarray
    items: list[tuple[int, np.ndarray]]
    classes: list[tuple[int, int, np.ndarray, np.ndarray]]
    anchors: tuple[np.ndarray, list[list[tuple[int, int]]]]
    starts: np.ndarray
    marks: np.ndarray
    sizes: np.ndarray


def least_product(weights: np.ndarray) -> float:
    """The least that the words of a verified copy weigh; ``weights``: of the item's words, squared."""
    same = np.sort(weights)[: int(np.ceil(SAME * len(weights) - 1e-9))].sum()
    answer, rest = weights[-ANSWER:], np.sort(weights[:-ANSWER])
    like = answer.sum() + rest[: max(0, int(np.ceil(LIKE * len(weights) - 1e-9)) - len(answer))].sum()
    return float(min(same, like))


def _times(rows: list[np.ndarray], right: np.ndarray) -> np.ndarray:
    """Sum of the words' rows of ``right`` for each passage."""
    out = np.zeros((len(rows), right.shape[1]))
    for i, ids in enumerate(rows):
        out[i] = right[ids].sum(axis=0)
    return out


def _right_space(spark: SparkSession, rows: list[np.ndarray], idf: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors (words by rank) of the passages' TF-IDF matrix.

    Randomised range finding: A'A is applied to a random start and to the result, with an
    orthogonal basis between; then the small Gram matrix of A on the basis is diagonalised.  Each
    product is a sum over blocks of passages that Spark's tasks compute.
    """
    width = len(idf)
    rank = min(rank, len(rows), width)
    keep = min(rank + SPARE, width)
    blocks = spark.createDataFrame(
        [(i, np.concatenate(rows[i : i + _ROWS]).astype("<i4").tobytes(), np.array([len(r) for r in rows[i : i + _ROWS]], "<i4").tobytes()) for i in range(0, len(rows), _ROWS)],
        "at long, ids binary, sizes binary",
    ).repartition("at")

    def summed(basis: np.ndarray, gram: bool) -> np.ndarray:
        shape = (keep, keep) if gram else (width, keep)

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                for ids, sizes in zip(batch["ids"], batch["sizes"], strict=True):
                    ids = np.frombuffer(ids, "<i4")
                    sizes = np.frombuffer(sizes, "<i4")
                    projected = _times(np.split(ids, np.cumsum(sizes)[:-1]), basis * idf[:, None])
                    total = np.zeros(shape) if total is None else total
                    if gram:
                        total += projected.T @ projected
                    else:
                        np.add.at(total, ids, np.repeat(projected, sizes, axis=0))
            if total is not None:
                for at in range(0, len(total), _CHUNK):
                    yield pd.DataFrame({"at": [at], "sums": [total[at : at + _CHUNK].tobytes()]})

        def added(frame: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(x) for x in frame["sums"])
            return pd.DataFrame({"at": frame["at"].iloc[:1], "sums": [total.tobytes()]})

        parts = blocks.mapInPandas(partial, "at int, sums binary").groupBy("at").applyInPandas(added, "at int, sums binary")
        got = parts.toPandas().sort_values("at")
        out = np.concatenate([np.frombuffer(x) for x in got["sums"]]).reshape(shape)
        return out if gram else out * idf[:, None]

    basis = np.random.default_rng(7).standard_normal((width, keep))
    for _ in range(2):
        basis, _ = np.linalg.qr(summed(np.linalg.qr(basis)[0], gram=False))
    values, vectors = np.linalg.eigh(summed(basis, gram=True))
    return basis @ vectors[:, np.argsort(-values)[:rank]]


def _anchors(items: list[tuple[int, np.ndarray]], idf: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Each item's rarest pair of neighbouring words; the only word of an item is paired with none."""
    width, found = len(idf) + 1, {}
    for number, (_, ids) in enumerate(items):
        place = int(np.argmax(idf[ids[:-1]] + idf[ids[1:]])) if len(ids) > 1 else 0
        second = int(ids[place + 1]) if len(ids) > 1 else width
        found.setdefault(int(ids[place]) * (width + 1) + second, []).append((number, place))
    pairs = np.array(sorted(found), dtype=np.int64)
    return pairs, [found[pair] for pair in pairs.tolist()]


def build_index(spark: SparkSession, items: list[tuple[int, np.ndarray]], vocabulary: dict[bytes, int], counts: np.ndarray, total: int, rank: int = RANK) -> Index:
    """The index of all items; ``counts``: documents that hold each word, of ``total``."""
    idf = np.log((total + 1.0) / (counts + 1.0)) + 0.1
    items = sorted(items, key=lambda item: len(item[1]) < LEAST_WORDS)
    rows = [ids for _, ids in items if len(ids) >= LEAST_WORDS]
    anchors = _anchors(items, idf)
    starts = np.zeros(len(idf) + 1, dtype=bool)
    starts[anchors[0] // (len(idf) + 2)] = True
    if not rows:
        empty = np.zeros((len(idf) + 1, 1), dtype=np.float32)
        return Index(vocabulary, empty, empty[:0], np.zeros(len(idf) + 1), items, [], anchors, starts, np.zeros((0, _BITS), np.uint16), np.zeros(0))
    space = _right_space(spark, rows, idf, rank) * idf[:, None]
    least = np.array([least_product(idf[ids] ** 2) for ids in rows])
    latent = _times(rows, space) / least[:, None]
    space = np.vstack([space, np.zeros(space.shape[1])]).astype(np.float32)

    def most_of(members: np.ndarray) -> np.ndarray:
        most = np.zeros(len(idf) + 1)
        for number in members.tolist():
            held, times = np.unique(rows[number], return_counts=True)
            most[held] = np.maximum(most[held], idf[held] ** 2 * times / least[number])
        return most

    marks = np.stack([np.bincount(ids % _BITS, minlength=_BITS).astype(np.uint16) for ids in rows])
    lengths = np.array([len(ids) for ids in rows])
    sizes = np.array([length_class(n) for n in lengths.tolist()])
    classes = []
    for size in np.unique(sizes).tolist():
        members = np.flatnonzero(sizes == size)
        for some in np.split(members, range(_MEMBERS, len(members), _MEMBERS)):
            classes.append((size + 3 * _step(size), min(_step(size), _LONGEST_STRIDE), some, most_of(some)))
    return Index(vocabulary, space, latent.astype(np.float32), most_of(np.arange(len(rows))), items, classes, anchors, starts, marks, lengths)


# --- verification ------------------------------------------------------------------------


def common_length(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of one number."""
    places: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for word in region.tolist():
        match = row & places.get(word, 0)
        row = ((row + match) | (row - match)) & full
    return len(item) - row.bit_count()


def verified(item: np.ndarray, region: np.ndarray) -> tuple[float, bool] | None:
    """Share of the item in the region and whether its answer is there; None for no leak."""
    held = set(region.tolist())
    if sum(w in held for w in item.tolist()) < LIKE * len(item):
        return None  # a subsequence cannot be longer than the words the two share
    share = common_length(item, region) / len(item)
    answer = item[-ANSWER:]
    answered = common_length(answer, region) == len(answer)
    return (share, answered) if share >= SAME or (share >= LIKE and answered) else None


# --- search ------------------------------------------------------------------------------


@dataclass
class Stream:
    """Documents one after another, each padded with words outside to a multiple of the longest stride."""

    ids: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, docs: list[np.ndarray], outside: int) -> Stream:
        sizes = np.array([len(ids) for ids in docs], dtype=np.int64)
        padded = np.maximum(-(-sizes // _LONGEST_STRIDE), 1) * _LONGEST_STRIDE
        begins = np.cumsum(padded) - padded
        ids = np.full(int(padded.sum()), outside, dtype=np.int32)
        for begin, doc in zip(begins.tolist(), docs, strict=True):
            ids[begin : begin + len(doc)] = doc
        return cls(ids, begins, begins + sizes)

    def doc_at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, places, side="right") - 1


def word_for_word(stream: Stream, index: Index) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Documents, item number and first words of whole copies."""
    pairs, held_by = index.anchors
    places = np.flatnonzero(index.starts[stream.ids])
    if not len(places):
        return
    width = len(index.space)
    first = stream.ids[places].astype(np.int64) * (width + 1)
    for keys in (first + np.append(stream.ids, width)[places + 1], first + width):
        at = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
        met = np.flatnonzero(pairs[at] == keys)
        if not len(met):
            continue
        met = met[np.argsort(at[met], kind="stable")]
        used, cuts = np.unique(at[met], return_index=True)
        for pair, group in zip(used.tolist(), np.split(places[met], cuts[1:]), strict=True):
            docs = stream.doc_at(group)
            for number, offset in held_by[pair]:
                item, begins = index.items[number][1], group - offset
                held = np.flatnonzero((begins >= stream.begins[docs]) & (begins + len(item) <= stream.ends[docs]))
                for i, word in enumerate(item.tolist()):
                    held = held[stream.ids[begins[held] + i] == word]
                if len(held):
                    yield docs[held], number, begins[held]


def near_regions(stream: Stream, index: Index, cosine: float = COSINE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Item numbers, first words, ends and cosines of the regions near an item in the latent space."""
    outside = len(index.space) - 1
    longest = max((size for size, *_ in index.classes), default=0)
    latent = index.latent / np.maximum(np.linalg.norm(index.latent, axis=1), 1e-12)[:, None]
    grain = np.repeat(stream.ends, np.diff(np.append(stream.begins, len(stream.ids))) // 4)
    for at in range(0, len(stream.ids) if index.classes else 0, _WORDS):
        part = stream.ids[at : at + _WORDS + longest]
        known = part != outside
        upto = np.concatenate([[0], np.cumsum(known)])
        held = part[known]
        likely = []
        covered = np.zeros(len(part) + 1, dtype=np.int32)
        for size, stride, members, most in index.classes:
            starts = np.arange(0, min(_WORDS, len(stream.ids) - at), stride)
            ends = np.maximum(np.minimum(starts + size, grain[(at + starts) // 4] - at), starts)
            # A little is added against rounding in what the bound leaves out.
            reach = np.concatenate([[0.0], np.cumsum(most[held])]) * 1.001
            some = np.flatnonzero(reach[upto[ends]] - reach[upto[starts]] >= 0.999)
            if len(some):
                likely.append((members, starts[some], ends[some]))
                np.add.at(covered, starts[some], 1)
                np.subtract.at(covered, ends[some], 1)
        if not likely:
            continue
        folds = known & (np.cumsum(covered[:-1]) > 0)
        upto = np.concatenate([[0], np.cumsum(folds)])
        sums = np.concatenate([np.zeros((1, index.space.shape[1])), np.cumsum(index.space[part[folds]], axis=0, dtype=np.float64)])
        for members, starts, ends in likely:
            folded = (sums[upto[ends]] - sums[upto[starts]]).astype(np.float32)
            folded /= np.maximum(np.linalg.norm(folded, axis=1), 1e-12)[:, None]
            cosines = folded @ latent[members].T
            r, c = np.nonzero(cosines >= cosine)
            if len(r):
                held = _shares_words(part, folds, starts, ends, r, c, index.marks[members], index.sizes[members])
                yield members[c[held]], at + starts[r[held]], at + ends[r[held]], cosines[r[held], c[held]]


def _shares_words(part: np.ndarray, known: np.ndarray, starts: np.ndarray, ends: np.ndarray, r: np.ndarray, c: np.ndarray, marks: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Pairs of region ``r`` and item ``c`` that may share ``LIKE`` of the item's words: words are
    told apart by their number modulo ``_BITS`` alone, which can only overstate what is shared."""
    used, row = np.unique(r, return_inverse=True)
    sizes_of = ends[used] - starts[used]
    rows = np.repeat(np.arange(len(used)), sizes_of)
    places = np.arange(len(rows)) - np.repeat(np.cumsum(sizes_of) - sizes_of - starts[used], sizes_of)
    rows, places = rows[known[places]], places[known[places]]
    bits = np.zeros((len(used), _BITS), dtype=np.float32)
    bits[rows, part[places] % _BITS] = 1
    shared = bits @ marks.T.astype(np.float32)
    return np.flatnonzero(shared[row, c] >= LIKE * sizes[c] - 1e-3)


def search(docs: list[np.ndarray], index: Index, cosine: float = COSINE) -> list[tuple[int, int, int, float, float, bool]]:
    """Items found in documents (word numbers): document, item id, first word, cosine, share, answered."""
    stream = Stream.of(docs, len(index.space) - 1)
    best: dict[tuple[int, int], tuple[int, float, float, bool]] = {}
    for found, number, begins in word_for_word(stream, index):
        for doc, begin in zip(found.tolist(), begins.tolist(), strict=True):
            first = begin - int(stream.begins[doc])
            if (doc, number) not in best or first < best[doc, number][0]:
                best[doc, number] = (first, 1.0, 1.0, True)
    whole = set(best)
    regions = [np.concatenate(column) for column in zip(*near_regions(stream, index, cosine), strict=True)]
    if regions:
        numbers, begins, ends, cosines = regions
        near = zip(stream.doc_at(begins).tolist(), numbers.tolist(), begins.tolist(), ends.tolist(), cosines.tolist(), strict=True)
        for doc, number, begin, end, near_by in near:
            if (doc, number) in whole:
                continue
            item, region = index.items[number][1], stream.ids[begin:end]
            held = verified(item, region)
            if held:
                first = begin - int(stream.begins[doc])
                key = (held[0], near_by, -first)
                if (doc, number) not in best or key > (best[doc, number][2], best[doc, number][1], -best[doc, number][0]):
                    best[doc, number] = (first, near_by, *held)
    return [(doc, index.items[number][0], *evidence) for (doc, number), evidence in best.items()]


def leaks(ids: np.ndarray, index: Index) -> list[tuple[int, int, float, float, bool]]:
    """Items found in one document (word numbers): item, first word, cosine, share, answered."""
    return [found[1:] for found in search([ids], index)]


# --- over all documents ------------------------------------------------------------------


_FOUND = "doc_id long, item_id long, first_word long, cosine double, share double, answered boolean"


def contaminated(docs: DataFrame, benchmark: DataFrame, rank: int = RANK) -> DataFrame:
    """``doc_id``, ``item_id`` and the evidence for each document that holds a benchmark item.

    Items without an id or without a word take no part.  An id that comes with several texts stands
    for each of them, the pair is reported once with its best evidence.  A null document text is empty; a row without a doc_id can be found
    and is reported without it.  Repeated rows are reported once.  Empty tables give no rows.
    """
    spark = docs.sparkSession
    # The benchmark is the stated query set; its blocks bound what is held at a time.
    listed = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text").distinct()
    listed = [(r[0], words(r[1])) for r in listed.orderBy("item_id", "text").toLocalIterator()]
    listed = [(i, w) for i, w in listed if w]
    vocabulary = {word: i for i, word in enumerate(sorted({w for _, ws in listed for w in ws}))}
    items = [(i, np.array([vocabulary[w] for w in ws], dtype=np.int32)) for i, ws in listed]
    if not items:
        return spark.createDataFrame([], _FOUND)
    numbered, counts, total = _numbered(docs, vocabulary)
    index = build_index(spark, items, {}, counts, total, rank)
    out = numbered.mapInPandas(_searcher(index), _FOUND)
    best = F.max_by(F.struct("first_word", "cosine", "share", "answered"), F.struct("share", "cosine", -F.col("first_word")))
    return out.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")


def _numbered(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[DataFrame, np.ndarray, int]:
    """The documents as word numbers, how many hold each word, and how many there are."""
    outside = len(vocabulary)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known, other = vocabulary.get, repeat(outside)
            ids = [np.array(list(map(known, words(t), other)), dtype="<i4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": ids})

    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    numbered = stage(rows.mapInPandas(number, "doc_id long, ids binary"), "leaks-words")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = np.zeros(outside + 1, dtype=np.int64), 0
        for batch in batches:
            n += len(batch)
            for ids in batch["ids"]:
                held[np.unique(np.frombuffer(ids, "<i4"))] += 1
        held[outside] = n  # the place of words outside counts documents
        yield pd.DataFrame({"word": np.flatnonzero(held), "n": held[held > 0]})

    counted = numbered.select("ids").mapInPandas(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(outside + 1, dtype=np.float64)
    counts[counted["word"]] = counted["n"]
    return numbered, counts[:-1], int(counts[-1])


def _searcher(index: Index) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A mapInPandas function: what the documents hold of the items, some documents at a time."""
    names = [field.split()[0] for field in _FOUND.split(", ")]

    def together(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[np.ndarray]]]:
        doc_ids, docs, n = [], [], 0
        for batch in batches:
            for doc_id, ids in zip(batch["doc_id"], batch["ids"], strict=True):
                doc_ids.append(doc_id)
                docs.append(np.frombuffer(ids, "<i4"))
                n += len(docs[-1]) + _LONGEST_STRIDE
                if n >= _TOGETHER:
                    yield doc_ids, docs
                    doc_ids, docs, n = [], [], 0
        if docs:
            yield doc_ids, docs

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for doc_ids, docs in together(batches):
            rows = [(doc_ids[doc], *evidence) for doc, *evidence in search(docs, index)]
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark item; each row stands for itself, whatever its doc_id."""
    rows = with_row_key(docs)
    found = contaminated(rows.select(F.col(ROW).alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias(ROW)).distinct()
    return rows.join(found, ROW, "left_anti").select(*docs.columns)
