"""Latent search of benchmark items: recall on reworded items, many items, regions at every place."""

import numpy as np
import pytest

from starmill.llm import decontaminate as D


def brute(doc, items):
    """Items that some window of the document verifies, every window of an item's length and half."""
    found, held = set(), set(doc.tolist())
    for i, item in items:
        if sum(w in held for w in item.tolist()) < D.LIKE * len(item):
            continue  # no window can share more with the item than the document does
        n = len(item) + len(item) // 2
        if any(D.verified(item, doc[at : at + n]) for at in range(max(1, len(doc) - len(item) + 1))):
            found.add(i)
    return found


def reworded(rng, item, kind, words):
    item = item.copy()
    n = len(item)
    if kind == "replaced":
        item[rng.permutation(n)[: n // 5]] = rng.choice(words, n // 5)
    elif kind == "answered":
        k = int(0.35 * n)
        item[rng.permutation(n - 5)[:k]] = rng.choice(words, k)
    else:
        at = np.sort(rng.permutation(n)[: n // 5])
        item = np.insert(item, at, rng.choice(words, len(at)))
    return item


@pytest.mark.parametrize("kind", ["replaced", "answered", "longer"])
def test_recall_on_reworded_items_below_full_rank(spark, kind):
    rng = np.random.default_rng(12)
    # Word frequencies fall like those of prose: common words are shared by all items.
    weights = 1.0 / np.arange(1, 1201)
    weights /= weights.sum()
    prose = lambda n: rng.choice(1200, n, p=weights).astype(np.int32)
    items = [(i, prose(int(n))) for i, n in enumerate(rng.integers(15, 60, 300))]
    docs = [prose(int(n)) for n in rng.integers(30, 120, 64)]
    for at, doc in enumerate(docs[::2]):
        cut = int(rng.integers(0, len(doc)))
        docs[2 * at] = np.concatenate([doc[:cut], reworded(rng, items[7 * at][1], kind, doc), doc[cut:]])
    counts = np.minimum(weights * 40_000, 9_000)
    index = D.build_index(spark, items, {}, counts, 10_000, rank=100)
    assert index.space.shape[1] == 100 < len(items)
    want = {(d, i) for d, doc in enumerate(docs) for i in brute(doc, items)}
    got = {(d, i) for d, i, *_ in D.search(docs, index)}
    assert len(want) >= 25
    assert len(want & got) >= 0.9 * len(want)
    # What the search adds was verified on a region; nothing else is reported.
    for d, i, first, cosine, share, answered in D.search(docs, index):
        assert share >= D.SAME or (share >= D.LIKE and answered)
        assert cosine >= D.COSINE and 0 <= first < len(docs[d])


def test_verbatim_copies_of_five_thousand_items(spark):
    rng = np.random.default_rng(13)
    items = [(i, rng.integers(0, 8000, int(n)).astype(np.int32)) for i, n in enumerate(rng.integers(1, 40, 5000))]
    index = D.build_index(spark, items, {}, rng.uniform(1, 900, 8000), 1000, rank=64)
    docs = [np.concatenate([rng.integers(0, 8001, 30), items[at][1], rng.integers(0, 8001, 30)]).astype(np.int32) for at in range(0, 5000, 25)]
    got = {(d, i) for d, i, *_ in D.search(docs, index)}
    assert got >= {(at // 25, at) for at in range(0, 5000, 25)}


def test_documents_of_one_stream_do_not_mix():
    ids = [np.array(x, dtype=np.int32) for x in ([1, 2], [], [3, 4, 5], [6] * 130)]
    stream = D.Stream.of(ids, 9)
    for doc, begin, end in zip(ids, stream.begins, stream.ends, strict=True):
        assert begin % D._LONGEST_STRIDE == 0 and stream.ids[begin:end].tolist() == doc.tolist()
    assert stream.doc_at(stream.begins).tolist() == [0, 1, 2, 3]


def test_half_items_at_neighbouring_documents_are_no_copy(spark):
    item = np.arange(40, dtype=np.int32)
    index = D.build_index(spark, [(7, item)], {}, np.full(40, 3.0), 100)
    assert D.search([item[:20], item[20:]], index) == []
    assert [(d, i) for d, i, *_ in D.search([item[:20], item, item[20:]], index)] == [(1, 7)]


def test_the_filter_on_shared_words_only_overstates():
    rng = np.random.default_rng(14)
    part = rng.integers(0, 900, 400).astype(np.int32)
    items = [rng.integers(0, 900, 12) for _ in range(20)] + [part[at : at + 12].copy() for at in range(0, 400, 40)]
    marks = np.stack([np.bincount(x % D._BITS, minlength=D._BITS).astype(np.uint16) for x in items])
    starts = np.arange(0, 380, 10)
    ends = starts + 20
    r, c = (x.ravel() for x in np.meshgrid(np.arange(len(starts)), np.arange(len(items)), indexing="ij"))
    kept = set(D._shares_words(part, part < 850, starts, ends, r, c, marks, np.full(len(items), 12)).tolist())
    for pair, (at, i) in enumerate(zip(r.tolist(), c.tolist(), strict=True)):
        region = part[starts[at] : ends[at]]
        if sum(w in set(region[region < 850].tolist()) for w in items[i].tolist()) >= D.LIKE * 12:
            assert pair in kept
