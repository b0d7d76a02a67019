"""Greedy string tiling against a plain reading of it, and benchmark items under disguises."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import ODD_ROWS
from tidemark.llm import decontaminate as dec
from tidemark.llm.common import read_table

SF = "/root/testdata/sf0.01"


def plain_tiles(item, doc, least):
    """The textbook form: look at all pairs of places for the longest free match, mark, repeat."""
    taken, used, tiles = [False] * len(item), [False] * len(doc), []
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and item[p + n] == doc[t + n] and not taken[p + n] and not used[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < least:
            return tiles
        tiles.append(best)
        for k in range(n):
            taken[p + k] = used[t + k] = True


def hashed(word_numbers):
    return (np.array(word_numbers, np.uint64) + np.uint64(1)) * np.uint64(0x2545F4914F6CDD1D)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=14), st.lists(st.integers(0, 3), max_size=18), st.integers(2, 4))
def test_tiles_are_those_of_the_textbook(item, doc, least):
    got, want = dec.tile(hashed(item), hashed(doc), least), plain_tiles(item, doc, least)
    assert max((n for n, _, _ in got), default=0) == max((n for n, _, _ in want), default=0)
    for n, p, t in got:
        assert item[p : p + n] == doc[t : t + n] and n >= least
    for side, size in ((1, len(item)), (2, len(doc))):
        places = [m[side] + k for m in got for k in range(m[0])]
        assert len(set(places)) == len(places) and all(x < size for x in places)
    taken = {m[1] + k for m in got for k in range(m[0])}
    used = {m[2] + k for m in got for k in range(m[0])}
    for p in range(len(item) - least + 1):  # nothing that a tile could still cover is left
        for t in range(len(doc) - least + 1):
            run = range(least)
            assert item[p : p + least] != doc[t : t + least] or any(p + k in taken or t + k in used for k in run)


def words(text):
    return [w for w in (re.sub(r"[\W_]+", "", w.lower()) for w in text.split()) if w]


def test_query_against_the_textbook(spark):
    docs = read_table(spark, SF, "documents").collect()
    items = read_table(spark, SF, "benchmark").collect()
    got = {(r.doc_id, r.item_id): r.coverage for r in dec.op6_benchmark_tiling(spark, SF).collect()}
    seeds = {}
    for i in items:
        w = words(i.text)
        for k in range(len(w) - 2):
            seeds.setdefault(tuple(w[k : k + 3]), set()).add(i.item_id)
    of_item, want = {i.item_id: words(i.text) for i in items}, {}
    for d in docs:
        w = words(d.text or "")
        common = Counter(i for g in {tuple(w[k : k + 3]) for k in range(len(w) - 2)} for i in seeds.get(g, ()))
        for item in [i for i, n in common.items() if n > 3]:
            here, grams = of_item[item], {tuple(of_item[item][k : k + 3]) for k in range(len(of_item[item]) - 2)}
            near = sorted({k + s for k in range(len(w) - 2) if tuple(w[k : k + 3]) in grams for s in range(3)})
            cut, last = [], None
            for k in near:  # words far from any shared run cannot lie in a tile
                cut += [None] * (last is not None and k > last + 1) + [w[k]]
                last = k
            tiles = [n for n, _, _ in plain_tiles(here, cut, 3)]
            covered = sum(tiles) / len(here)
            if covered >= dec.SHARE or max(tiles, default=0) >= dec.LONG:
                want[d.doc_id, item] = covered
    assert len(want) > 5
    assert got == pytest.approx(want)


PASSAGE = (
    "The quick brown fox jumps over the lazy dog near the old river bank. Nobody saw how the seven grey geese crossed "
    "the frozen lake before dawn. A letter from the distant harbour arrived three days too late for them."
)


def found(spark, docs, text, items=((1, PASSAGE),), **more):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in dec.find_items(docs(text), bench, **more).collect())


def test_disguised_items(spark, docs):
    first, second, third = re.split(r"(?<=\.) ", PASSAGE)
    filler = " ".join(f"filler{k}" for k in range(200))
    texts = [
        (1, f"{filler} {PASSAGE} {filler}"), (2, f"{third} {filler} {first} {filler} {second}"), (3, PASSAGE.upper().replace(".", " !!")),
        (4, first), (5, f"{first} {filler}"), (6, filler), (7, None), (8, " ".join(random.Random(1).sample(PASSAGE.split(), len(PASSAGE.split())))),
    ]
    assert found(spark, docs, texts) == [(1, 1), (2, 1), (3, 1)]
    clean = dec.drop_contaminated(docs(texts), spark.createDataFrame([(1, PASSAGE)], "item_id long, text string"))
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 6, 7, 8] and clean.columns == docs([]).columns


def test_blocks_give_the_same(spark, docs):
    texts = [(k, f"{k} {PASSAGE if k % 3 else 'nothing here'}") for k in range(30)]
    items = [(k, PASSAGE.replace("seven", str(k))) for k in range(40)] + [(50, None), (51, ""), (52, "too short"), (53, "!!"), (0, PASSAGE.replace("seven", "0"))]
    whole = found(spark, docs, texts, items)
    assert len(whole) == 20 * 40 and whole == found(spark, docs, texts, items, block_bytes=3000)


def test_short_items_match_whole_documents_only(spark, docs):
    texts = [(1, "too short"), (2, "Too, SHORT!"), (3, "this is too short"), (4, "short")]
    assert found(spark, docs, texts, [(9, "too short")]) == [(1, 9), (2, 9)]


def test_reordered_runs_of_four_words(spark, docs):
    """No run of five words is left, the case that tiling is for."""
    w = words(PASSAGE)
    runs = [w[k : k + 4] for k in range(0, len(w), 4)]
    random.Random(3).shuffle(runs)
    mixed = " ".join(" ".join([*r, f"noise{k}"]) for k, r in enumerate(runs))
    assert found(spark, docs, [(1, f"{'filler ' * 300}{mixed}"), (2, " ".join(" ".join([*r[:2], "x"]) for r in runs))]) == [(1, 1)]


def test_a_long_tile_is_enough(spark, docs):
    item = " ".join(f"w{k}" for k in range(1000))
    texts = [(1, " ".join(item.split()[100:800])), (2, " ".join(item.split()[100:149])), (3, " ".join(item.split()[100:150]))]
    assert found(spark, docs, texts, [(7, item)]) == [(1, 7), (3, 7)]


def test_scripts_without_blanks(spark, docs):
    item = "今天的天气非常好我们一起去公园散步然后回家吃饭看电视"
    assert found(spark, docs, [(1, f"早上好。{item}。明天再见"), (2, item[13:] + "很远很远" + item[:13]), (3, "今天的天气不好我不想去")], [(4, item)]) == [(1, 4), (2, 4)]


def test_twins_among_short_items(spark, docs):
    items = [(1, "too short"), (2, "Too short!"), (3, "three small words"), (4, "three small words")]
    assert found(spark, docs, [(1, "too short"), (2, "these are three small words here")], items) == [(1, 1), (1, 2), (2, 3), (2, 4)]


def test_odd_rows_and_empty_tables(spark, docs):
    rows = [*ODD_ROWS, (9, PASSAGE), (9, PASSAGE), (None, PASSAGE)]
    bench = spark.createDataFrame([(1, PASSAGE, 3), (None, "word " * 50, 4), (2, None, 5)], "item_id long, text string, doc_id int")
    got = [(r.doc_id, r.item_id) for r in dec.find_items(docs(rows), bench).collect()]
    assert sorted(got, key=str) == sorted([(9, 1), (9, 1), (None, 1), (4, None)], key=str)
    assert found(spark, docs, [], [(1, PASSAGE)]) == [] and found(spark, docs, rows, [(None, None)]) == []


def test_repeated_words_do_not_explode():
    one = hashed([1] * 20_000)
    assert dec.tile(one[:60], one) == [(60, 0, 0)]
    assert list(dec.Items([1], pa.array(["a " * 70], pa.large_string())).contained(pa.array(["a " * 20_000], pa.large_string()), 0.8))[0][2] == 70
