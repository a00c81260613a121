import random

from tidemark.llm import decontaminate as m


def grams(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = set()
    for i, t in items:
        n = min(5, len((t or "").split()))
        g = grams(t, n) if n and i is not None else set()
        for d, x in docs:
            found = len(g & grams(x, n)) if g and d is not None else 0
            if g and found * 100 >= len(g) * 80:
                out.add((d, i, found, len(g)))
    return out


def test_equals_brute_force(spark, docs_of):
    rng = random.Random(1)
    word = lambda: f"W{rng.randrange(300)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 6, 12, 33, 64])))) for i in range(30)]
    items += [(None, "a b c d e f"), (50, None), (51, " "), (3, items[3][1]), (52, items[9][1])]
    docs = []
    for d in range(150):
        w = [word() for _ in range(rng.randrange(60))]
        if d % 3 == 0:
            x = rng.choice(items[:30])[1].split()
            if len(x) > 8 and d % 2:
                x[rng.randrange(len(x))] = "zz"
            w[len(w) // 2 : len(w) // 2] = x
        docs.append((d, "\n".join(w).lower() if d % 4 else "  ".join(w)))
    docs += [(None, items[4][1]), (900, None), (901, ""), (902, " ".join(["q"] * 100_000) + " " + items[6][1]), docs[3]]
    got = m.find_leaks(docs_of(docs), docs_of(items, "item_id long, text string")).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == brute(docs, items)


def test_empty_tables_and_clashing_columns(spark, docs_of):
    item = docs_of([(1, "a b c d e f")], "item_id long, text string")
    assert m.find_leaks(docs_of([]), item).count() == 0
    docs = docs_of([(1, "x A b c d E f", 5, "h")], "doc_id long, text string, item_id int, h string")
    assert m.find_leaks(docs, item.limit(0)).count() == 0
    assert [tuple(r) for r in m.find_leaks(docs, item).collect()] == [(1, 1, 2, 2)]
