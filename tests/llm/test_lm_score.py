import inspect
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from tidemark.llm import lm_score as m
from tidemark.llm.common import words_of
from tidemark.llm.packing import vocabulary


def test_base_equals_brute_force_and_odd_rows(docs_of):
    rows = [(i, " ".join(f"W{(i * j) % 37}" for j in range(i % 90))) for i in range(120)]
    rows += [(None, "w1 w2"), (500, None), (501, ""), (7, "w1 é zz"), (7, "w1 é zz"), (502, "q " * 30_000), (503, "x y 日本   z")]
    out = m.score_texts(docs_of(rows), vocabulary(), rounds=1, share=2, block_docs=40).collect()
    train = [t for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 7 != 2]
    c = Counter(w for t in train for w in [*words_of(t), b""])
    n, v = sum(c.values()), len(c)
    want = []
    for d, t in rows:
        tokens = [*words_of(t), b""]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens)
        want.append((d, d is not None and zlib.crc32(str(d).encode()) % 7 == 2, len(tokens), sum(c[w] > 0 for w in tokens), n, round(base, 5)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    assert m.score_texts(docs_of([]), vocabulary()).count() == 0


def random_words(rng, n, most=5):
    """Kinds of the ids of ``n`` words, the last of them the end, their counts, and the chain that these teach."""
    size = rng.integers(1, most + 1, n)
    size[-1] = 1
    kinds = rng.integers(m.CLASSES + 2, m.CLASSES + 7, size.sum())
    kinds[np.cumsum(size) - size] = rng.integers(0, 12, n)
    c = rng.integers(1, 40, n)
    counts, bits = m.chain_rows(kinds, c)
    return kinds, c, m.chain_of(counts.reshape(-1, m.PARTS), bits)


def masses(kinds, c):
    path = m.steps(kinds)[-1]
    return np.array([(c[path == x] + 1).sum() for x in path])


def test_every_training_document_trains_the_model(docs_of):
    rows = docs_of([(i, "alpha beta gamma " * (1 + i % 5)) for i in range(200)]).withColumn("learn", m.learns())
    shares = np.full(m.CLASSES, 1 / m.CLASSES)
    told = inspect.signature(m.score_texts).parameters
    default = (told["rounds"].default, told["share"].default)
    ids, _ = m._ids(["alpha", "beta", "gamma", ""], m.subwords(**vocabulary()))
    kind, _ = m.kinds_of(np.bincount(ids, minlength=m.END_ID + 1), spaced())
    counts, bits = m.chain_rows(kind[ids], np.ones(4, np.int64))
    chain = m.chain_of(counts.reshape(-1, m.PARTS), bits)
    want = sum((1 + r.doc_id % 5) * (len(ids) - 1) + 1 for r in rows.where("learn").collect())
    for rounds, part in (default, (1, 2)):
        p, seen = m.fit(rows, kind, chain, shares, vocabulary(), rounds, part)
        assert seen == want and np.isfinite(p["embed"]).all()
    left_out = rows.where("pmod(xxhash64(doc_id), 24) >= 3")  # three rounds of 1/24 saw none of these
    p, seen = m.fit(left_out, kind, chain, shares, vocabulary(), *default)
    assert seen and not np.allclose(p["embed"], m.first_parameters(shares)["embed"])


def spaced():
    encoder = m.subwords(**vocabulary())
    return np.array([i < m.END_ID and encoder.fast.decode_single_token_bytes(i)[:1] == b" " for i in range(m.END_ID + 1)])


def test_windows_score_each_token_once_and_causally():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 5, 48, 49, 80, 81, 200])
    start, size, opens = m.windows(lengths)
    seen = Counter()
    for s, k, o in zip(start, size, opens):
        seen.update(range(s if o else s + m.WINDOW - m.STRIDE, s + k))
    assert seen == Counter(range(lengths.sum()))
    p = m.first_parameters(np.full(m.CLASSES, 1 / m.CLASSES))
    kinds, _, chain = random_words(rng, 80)
    words, tokens = m.Words(kinds, chain), rng.integers(0, 80, lengths.sum())
    one = m.score_tokens(p, words, tokens, lengths)
    assert np.allclose(one, m.score_tokens(p, words, tokens, lengths, batch=3), atol=1e-4)
    other = tokens.copy()
    other[-1] = (other[-1] + 1) % 80  # the last token changes nothing before it
    assert np.allclose(one[:-1], m.score_tokens(p, words, other, lengths)[:-1], atol=1e-5)
    swapped = kinds.copy()  # a later id of the word before the last changes the last token's score
    longest = int(np.argmax(words.size[:-1]))
    swapped[words.at[longest] + 1] = m.CLASSES + 9
    tokens[-2:] = longest, 79
    assert not np.isclose(m.score_tokens(p, words, tokens, lengths)[-1], m.score_tokens(p, m.Words(swapped, chain), tokens, lengths)[-1], atol=1e-6)


def test_gradients_and_learning():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in m.first_parameters(np.full(m.CLASSES, 1 / m.CLASSES)).items()}
    kinds, _, chain = random_words(rng, 40)
    words = m.Words(kinds, chain)
    assert words.steps.sum() > 40
    x, y = rng.integers(0, 40, (2, 12)), rng.integers(0, 40, (2, 12))
    x[:, 0] = 40  # the start
    live = np.ones((2, 12))
    live[1, 9:] = 0
    g = m.gradients(p, words, x, y, live)

    def loss(q):
        h = m.forward(q, words.vectors(q)[x])[-1]
        return -m.log_shares(q, h[live > 0], words, y[live > 0]).mean()

    assert set(g) == set(p)
    for n in p:
        where = {"embed": [(int(kinds[words.at[x[0, 2]]]), 3), (m.CLASSES, 1), (m.CLASSES + 4, 2)], "place": [(3, 3)], "next": [(4, 0), (2, 3)]}
        for i in where.get(n, [tuple(s // 2 for s in p[n].shape)]):
            up, down = ({k: v.copy() for k, v in p.items()} for _ in range(2))
            up[n][i] += 1e-5
            down[n][i] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - g[n][i]) < 1e-7, n
    kinds = np.concatenate([[i % 3, m.CLASSES + 2 + i // 3] for i in range(9)] + [[5]])
    counts, bits = m.chain_rows(kinds, np.ones(10, np.int64))
    words, tokens, lengths = m.Words(kinds, m.chain_of(counts.reshape(-1, m.PARTS), bits)), np.tile(np.arange(10), 600), np.full(60, 100)
    q = m.first_parameters(np.full(m.CLASSES, 1 / m.CLASSES))
    for t in range(25):
        q = m.train(q, words, tokens, lengths, t, batch=8)
    assert m.score_tokens(q, words, tokens, lengths).mean() > -2.0  # shares alone would give -2.3


def test_class_shares_sum_to_one():
    counts = np.random.default_rng(0).integers(0, 50, m.END_ID + 1)
    kind, log_share, _ = m.classes_of(counts, np.arange(m.END_ID + 1) % 3 == 0)
    assert np.allclose(np.bincount(kind, np.exp(log_share)), 1)


def test_words_of_very_many_blocks_and_brute_force_of_the_score(docs_of):
    """One block for each document, so that frequent words take the broadcast; scores against plain formulas with the same parameters."""
    rows = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1 + i % 60)) + f" only{i}") for i in range(300)]
    told = vocabulary()
    whole = {r.doc_id: r for r in m.score_texts(docs_of(rows), told).collect()}
    split = {r.doc_id: r for r in m.score_texts(docs_of(rows), told, block_docs=1).collect()}
    assert all(math.isclose(whole[d].score, split[d].score, rel_tol=1e-6) and math.isclose(whole[d].base_score, split[d].base_score, rel_tol=1e-9) for d in whole)

    held = {d for d, _ in rows if zlib.crc32(str(d).encode()) % 7 == 2}
    c = Counter(w for d, t in rows if d not in held for w in [*words_of(t), b""])
    once, n = sum(x == 1 for x in c.values()), sum(c.values())
    unseen = (once + 1) / (n + once + 2)
    encoder = m.subwords(**told)
    ids_of = lambda w: encoder.encode_words([w.decode()])[0].tolist() if w else [m.END_ID]
    counts = Counter()
    for w, x in c.items():
        counts.update({i: k * x for i, k in Counter(ids_of(w)).items()})
    kind, shares = m.kinds_of(np.array([counts[i] for i in range(m.END_ID + 1)]), spaced())
    spell = {w: tuple(kind[ids_of(w)].tolist()) for w in {x for _, t in rows for x in [*words_of(t), b""]}}
    mass, after, follow = Counter(), Counter(), {}
    part = lambda k: k - m.CLASSES - 1
    for w, x in c.items():
        mass[spell[w]] += x + 1
        for j in range(len(spell[w])):
            chosen = part(spell[w][j + 1]) if j + 1 < len(spell[w]) else 0
            after[spell[w][0], part(spell[w][j]) if j else 0, chosen] += x
            follow.setdefault(spell[w][: j + 1], set()).add(chosen)
    flat = np.concatenate([spell[w] for w in c])
    table, bits = m.chain_rows(flat, np.array(list(c.values())))
    learned = docs_of(rows).withColumn("learn", m.learns())
    p, _ = m.fit(learned, kind, m.chain_of(table.reshape(-1, m.PARTS), bits), shares, told, 3, 3)
    vector = lambda s: p["embed"][list(s)].sum(0) / math.sqrt(len(s))
    many = 0
    for d, t in rows[:20]:
        tokens, want = [*words_of(t), b""], 0.0
        for at, w in enumerate(tokens):
            if w not in c:
                want += math.log10(unseen)
                continue
            first = 0 if at < m.WINDOW else m.STRIDE * (1 + (at - m.WINDOW) // m.STRIDE)  # of the window that scores it
            before = [spell[tokens[i - 1]] if i else (m.CLASSES,) for i in range(first, at + 1)]
            r = m.forward(p, np.stack([vector(s) for s in before])[None].astype(np.float32))[-1][0, -1]
            z = np.exp(r @ p["out"] + p["bias"])
            chance, s = z[spell[w][0]] / z.sum(), spell[w]
            for j in range(len(s)):
                weights = {k: after[s[0], part(s[j]) if j else 0, k] * math.exp(r @ p["next"][:, k]) for k in follow[s[: j + 1]]}
                chance *= weights[part(s[j + 1]) if j + 1 < len(s) else 0] / sum(weights.values())
                many += len(weights) > 1
            want += math.log10((1 - unseen) * chance * (c[w] + 1) / mass[s])
        assert math.isclose(whole[d].score, want, rel_tol=1e-4), (d, whole[d].score, want)
    assert many > 100  # later ids count


def test_probabilities_of_all_events_sum_to_one():
    """The chances of each known word, the end and the event of an unseen word, after any context."""
    rng = np.random.default_rng(1)
    kinds, c, chain = random_words(rng, 301)
    mass = masses(kinds, c)
    kinds, c, mass = np.append(kinds, [3, m.CLASSES + 3]), np.append(c, 0), np.append(mass, 0)  # one word that is unseen
    words = m.Words(kinds, chain, c > 0)
    shares = np.bincount(words.head[:-1], minlength=m.CLASSES) / 301
    p = m.first_parameters(shares)
    context = rng.integers(0, 302, 12)
    for cut in (0, 1, 12):
        after = [m.token_logs(p, words, 0.03, c, mass, np.append(context[:cut], w), np.array([cut + 1]))[-1] for w in range(302)]
        x = np.append(len(words.at) - 1, context[:cut])
        r = m.forward(p, words.vectors(p)[x][None])[-1][0, -1]
        z = np.exp(r @ p["out"] + p["bias"])
        lost = z[shares == 0].sum() / z.sum()  # of classes that hold no training word
        assert abs(np.exp(after).sum() - 1 + 0.97 * lost) < 1e-4 and lost < 0.01


def test_held_out_texts_score_above_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = m.score_texts(docs, vocabulary())
    got = {r.held_out: r for r in out.groupBy("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).collect()}
    assert all(got[side].score > got[side].base for side in (True, False))


def test_columns_with_clashing_names_change_nothing(docs_of):
    docs = docs_of([(i, f"one two w{i % 7} three") for i in range(40)])
    more = docs.select("*", *(F.lit(9).alias(k) for k in ("block", "of", "learn", "ids", "number", "word", "c", "mass", "path", "score", "held_out")))
    plain, clashing = ({r.doc_id: r for r in m.score_texts(d, vocabulary(), rounds=1, share=1).collect()} for d in (docs, more))
    assert plain.keys() == clashing.keys() and list(plain[0].asDict()) == list(clashing[0].asDict())
    assert all(math.isclose(plain[d].score, clashing[d].score, rel_tol=1e-6) and plain[d][:6] == clashing[d][:6] for d in plain)


def test_totals_of_a_block_travel_packed():
    """Few rows whatever the number of words, in a few bytes a word; numbers, totals and masses come back."""
    rng = np.random.default_rng(3)
    block, number = rng.integers(0, 3, 40_000) << 32, rng.permutation(40_000).astype(np.int32)
    total, mass = rng.integers(1, 200, 40_000), rng.integers(1, 1 << 40, 40_000)
    whole = pa.record_batch({"block": block, "number": number, "total": total, "mass": mass})
    rows = list(m._packed(15_000)(whole.slice(lo, 7_000) for lo in range(0, 40_000, 7_000)))
    assert [b.num_rows for b in rows] == [3, 3]
    rows = pa.Table.from_batches(rows)
    for k in np.unique(block):
        got = dict(zip(*(x.tolist() for x in m._unpacked(rows.filter(pc.equal(rows["block"], k)))[:2]), strict=True))
        assert got == dict(zip(number[block == k].tolist(), total[block == k].tolist(), strict=True))
        n, _, back = m._unpacked(rows.filter(pc.equal(rows["block"], k)))
        assert (back[np.argsort(n)] == mass[block == k][np.argsort(number[block == k])]).all()
    assert all(len(x) == 0 for x in m._unpacked(rows.slice(0, 0)))


def test_blocks_split_words_by_the_rule_and_teach_what_texts_teach(monkeypatch):
    """A block is one row that spells each word once; tokens are those of the word rule, and training reads the same from blocks and texts."""
    rng = np.random.default_rng(2)
    letters = np.array(list("aAbZé日 \t\n\x0b\x0c\r\x1c\x85\xa0\x00Éß.  "))
    texts = ["".join(rng.choice(letters, n)) for n in rng.integers(0, 40, 600)] + [None, "", " ", " a", "a ", "W " * 500]
    tokens, lengths, words = m.tokens_of(pa.chunked_array([texts[:50], texts[50:]]))
    words = words.to_pylist()
    got = [[words[i].encode() for i in x] for x in np.split(tokens, np.cumsum(lengths)[:-1])]
    assert got == [[*words_of(t), b""] for t in texts]

    told, part = vocabulary(), np.arange(len(texts)) % 3
    learn = np.arange(len(texts)) % 7 != 2
    rows = pa.record_batch({"doc_id": pa.array(range(len(texts))), "learn": pa.array(learn), "part": pa.array(part), "text": pa.array(texts)})
    monkeypatch.setattr(m, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 1)}))}))
    listed = list(m._listed(150, 1 << 20, told)[0](rows.slice(lo, 100) for lo in range(0, len(texts), 100)))
    blocks = [b for b in listed if b["number"].null_count]
    assert [b.num_rows for b in blocks] == [1] * 5
    distinct = sum(len({w for t in texts[lo : lo + 150] for w in [*words_of(t), b""]}) for lo in range(0, len(texts), 150))
    assert sum(b.num_rows for b in listed) - 5 == distinct
    kind, _ = m.kinds_of(np.ones(m.END_ID + 1, np.int64), spaced())

    def laid(taught):
        words = np.split(taught.kinds, np.flatnonzero(taught.kinds < m.CLASSES)[1:])
        return [words[i].tolist() for i in taught.tokens], taught.lengths.tolist(), taught.size

    mine = rows.filter(pa.array(learn & (part == 1)))
    for most in (1 << 20, 700, 1):
        want = [laid(x) for x in m._of_texts([mine], kind, told, most)]
        assert [laid(x) for x in m._of_blocks(blocks, kind, 1, most)] == want and len(want) >= (1 if most > 700 else 3)


def test_layers_hold_every_number_of_every_run():
    rng = np.random.default_rng(4)
    size = np.sort(np.append(rng.integers(0, 6, 200), [40, 300]))[::-1]
    first = np.cumsum(size) - size
    for few in (0, 16, 500):
        got = sorted((r, x) for n, rows, at, _ in m.layers(first, size, few) for r, x in zip(np.arange(len(size))[rows].tolist(), at.tolist(), strict=True))
        assert got == [(r, f + j) for r, (f, n) in enumerate(zip(first.tolist(), size.tolist(), strict=True)) for j in range(n)]
    assert not list(m.layers(first[:0], size[:0])) and not list(m.layers(first[:2], np.zeros(2, int)))
