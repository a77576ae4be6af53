import random

import pytest

from calltide.llm import decontaminate
from calltide.llm.decontaminate import tile

ITEM = "which of these rivers crosses the largest number of borders on its way from the mountains to the distant sea"


@pytest.mark.parametrize("seed", range(30))
def test_tiles_are_a_maximal_greedy_cover(seed):
    rng = random.Random(seed)
    text, item = [rng.randrange(4) for _ in range(rng.randint(0, 60))], [rng.randrange(1, 5) for _ in range(rng.randint(1, 30))]
    tiles = tile(text, item, 3)
    in_text, in_item = [False] * len(text), [False] * len(item)
    for t, p, k in tiles:
        assert k >= 3 and text[t : t + k] == item[p : p + k]
        assert not any(in_text[t : t + k]) and not any(in_item[p : p + k])
        in_text[t : t + k] = in_item[p : p + k] = [True] * k
    for t in range(len(text) - 2):
        for p in range(len(item) - 2):
            free = not any(in_text[t : t + 3]) and not any(in_item[p : p + 3])
            assert not (free and text[t : t + 3] == item[p : p + 3])
    if tiles:
        longest = max(
            (k for t in range(len(text)) for p in range(len(item)) for k in range(1, 40)
             if t + k <= len(text) and p + k <= len(item) and text[t : t + k] == item[p : p + k]), default=0
        )
        assert max(k for _, _, k in tiles) == longest


def found(docs, benchmark, **options):
    got = decontaminate.decontaminate(docs, benchmark, **options).collect()
    return {(r.doc_id, r.text): [(m.item_id, round(m.coverage, 3)) for m in r.matches] for r in got}


@pytest.mark.parametrize("block_chars", [1, 8_000_000])
def test_passages_are_found_in_any_order(frame, edge_rows, spark, block_chars):
    w = ITEM.split()
    moved = " ".join(w[12:] + ["and", "so"] + w[6:12] + ["then"] + w[:6])
    rows = [
        *edge_rows, (30, "before it " + ITEM.upper() + ", and after"), (31, moved), (32, " ".join(w[::-1])), (33, " ".join(w[:6])),
        (34, "Yes: No!"), (35, ("filler text " * 5000) + ITEM), (36, "unrelated words of the largest kind on its way"),
    ]
    benchmark = spark.createDataFrame([(1, ITEM), (2, "yes no"), (3, None), (4, ""), (5, "?!"), (None, ITEM), (2, "yes no")], "item_id long, text string")
    got = found(frame(rows), benchmark, block_chars=block_chars)
    hits = {doc: [i for i, _ in m] for (doc, _), m in got.items() if m}
    assert hits == {30: [1, None], 31: [1, None], 34: [2, 2], 35: [1, None]}
    assert all(c >= 0.5 for m in got.values() for _, c in m)


def test_nothing_to_compare(frame, edge_rows, spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert all(not m for m in found(frame(edge_rows), nothing).values())
    assert found(frame([]), spark.createDataFrame([(1, ITEM)], "item_id long, text string")) == {}


def brute_tiles(text, item, n):
    """Marks the longest free common run, the earliest of equally long ones, until none of ``n`` tokens is left."""
    in_text, in_item, out = [False] * len(text), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for t in range(len(text)):
            for p in range(len(item)):
                k = 0
                while (
                    t + k < len(text) and p + k < len(item) and text[t + k] == item[p + k] and not in_text[t + k] and not in_item[p + k]
                ):
                    k += 1
                best = min(best, (-k, t, p))
        if -best[0] < n:
            return out
        k, t, p = -best[0], *best[1:]
        in_text[t : t + k] = in_item[p : p + k] = [True] * k
        out.append((t, p, k))


@pytest.mark.parametrize("seed", range(40))
def test_tiles_equal_brute_force(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(decontaminate, "START", rng.choice([2, 5, 32]))
    letters = rng.choice([1, 2, 3, 6])
    text, item = [rng.randrange(letters + 1) for _ in range(rng.randint(0, 40))], [rng.randrange(1, letters + 1) for _ in range(rng.randint(1, 25))]
    n = rng.randint(1, 4)
    assert sorted(tile(text, item, n)) == sorted(brute_tiles(text, item, n))


@pytest.mark.parametrize(("text", "item"), [([7] * 20_000, [7] * 300), ([7] * 20_000, [7] * 150 + [8] + [7] * 149)])
def test_repeated_tokens_take_linear_time(text, item):
    import time

    begun = time.process_time()
    tiles = tile(text, item)
    assert time.process_time() - begun < 2 and sum(k for _, _, k in tiles) >= 299


def test_column_of_the_result_name_is_kept(frame, spark):
    got = decontaminate.decontaminate(frame([(1, ITEM)]), spark.createDataFrame([(1, ITEM)], "item_id long, text string")).first()
    assert got.matches[0].item_id == 1 and got.matches_ == "7"
