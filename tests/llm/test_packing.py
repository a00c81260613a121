import zlib

import numpy as np
from tokenizers import Tokenizer

from tidemark.llm import packing as m

TEXTS = ["", None, "a b", " lead", "two  blanks\n\nlines \n x", "don't ça Éa — “q” <|endoftext|> \t日本 é", "word " * 9000]


def test_pieces_are_the_tokenizer_ids_and_windows_hold_each_id_once(docs_of):
    rows = [(i, t) for i, t in enumerate(TEXTS * 3)] + [(None, "x"), (3, TEXTS[3])]
    got = m.pack(m.token_pieces(docs_of(rows), m.vocabulary(), keep_ids=True), batch=16).toPandas()
    slow = Tokenizer.from_file(m.vocabulary()["json_path"])
    want = sorted(str([*slow.encode(t or "", add_special_tokens=False).ids, 1]) for _, t in rows)
    docs, key = [], got.doc_id.fillna(-1)
    for _, g in got.assign(k=key).sort_values("start").groupby("k"):
        for start, length, crc, ids in zip(g.start, g.length, g.ids_crc32, g.ids):
            assert zlib.crc32(np.asarray(ids, "<u4").tobytes()) == crc and len(ids) == length
            if start == 0:
                docs.append({})
        whole = np.concatenate(g[~g.start.duplicated()].ids.to_numpy())
        docs[-1] = str(whole.tolist())
        docs = [d if isinstance(d, str) else str(whole.tolist()) for d in docs]
    assert sorted(docs) == want
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= 2048 and (g.offset.to_numpy() == g.length.cumsum().shift(fill_value=0).to_numpy()).all()


def test_differencing_against_brute_force_and_capacity():
    rng = np.random.default_rng(1)
    for n, k in ((1, 1), (5, 3), (40, 7), (3, 9)):
        sizes = rng.integers(1, 500, n)
        of, sums = m.differencing(sizes, k)
        assert sorted(np.bincount(of, sizes, minlength=len(sums)).astype(int)) == sorted(sums)
    sizes = np.array([8, 7, 6, 5, 4])  # the classic case: 16 and 14
    assert sorted(m.differencing(sizes, 2)[1]) == [14, 16]
    sizes = rng.integers(1, 513, 3000)
    of = m.windows_of(sizes, 2048)
    assert np.bincount(of, sizes).max() <= 2048 and sizes.sum() / (2048 * (of.max() + 1)) > 0.99
    assert m.windows_of(np.full(9, 1100), 2048).max() == 8


def test_empty_table(docs_of):
    assert m.pack(m.token_pieces(docs_of([]), m.vocabulary())).count() == 0
