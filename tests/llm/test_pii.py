import hashlib
import random
import re

import pytest

from tidemark.llm import pii as m

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, s):
    d = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(d[::-1])) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def brute(text):
    out = [(x.start(), i, x.end()) for i, k in enumerate(m.KINDS) for x in re.finditer(BASE[k], text or "") if valid(k, x.group())]
    return [(s, i, e) for s, i, e in sorted(out)]


def spans(rows):
    return [[(s.start, s.kind, s.end) for s in r.base] for r in rows]


def test_base_spans_equal_python_on_odd_texts(docs_of):
    rng = random.Random(0)
    parts = ["a@b.c", "@", ".", "_x@y.z", "1.2.3.4", "256.1.1.1", "007.0.0.255", "1.2.3.4.5.6.7.8", "+1 (456) 555-2186", "4111 1111 1111 1111", "4111-1111--1111",
             "4041894974608795", "é", "😀", " ", "  ", "\n", "word", "+", "-", "12", "x@y@b.c", "a@b..c", "%+-@q-.r", "(", "\x0b", "5.", "+49.30.1234567 8"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(400)]
    texts += [None, "", "1.2.3.4 " * 700 + "x", "9" * 60_000, "1 " * 20_000, "a" * 60_000 + "@", "+1" + " " * 60_000, "z" * 400_000]
    rows = m.find_pii(docs_of(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert spans(rows) == [brute(t) for t in texts]


def test_query_on_a_whole_table_and_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in m.op10_pii(spark, "/root/testdata/sf0.01").collect():
        want = brute(docs[r.doc_id])
        said = [f"{m.KINDS[k]}:{s}:{e}" for s, k, e in want]
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r.spans.split(",")) or not said
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in want) for i in range(4))


def test_contexts_discover_unseen_identifiers_and_leave_others(docs_of):
    rows = [(i, f"hello there. Please reach me at +1 (456) 555-{2000 + i} today") for i in range(12)]
    rows += [(20, "so reach me at 555-0142-99, soon"), (21, "now, Reach me at 55x0143; or on page 55x0143 later"), (22, "the version of 4.0.17 is out")]
    rows += [(30 + i, f"the version of {i}.{i}.17.9 is out") for i in range(2)] + [(40 + i, f"the version of tool{i}x9z is out") for i in range(30)]
    got = {r.doc_id: [(s.kind, rows_text[s.start : s.end]) for s in r.spans] for rows_text, r in ((dict(rows)[r.doc_id], r) for r in m.find_pii(docs_of(rows)).collect())}
    assert got[20] == [(3, "555-0142-99")] and got[21] == [(3, "55x0143")]
    assert got[22] == [] and all(got[40 + i] == [] for i in range(30))


def test_words_without_digits_spaced_numbers(docs_of):
    rows = [(i, f"well. Please write to u{i}@mail.example soon") for i in range(12)] + [(100 + i, f"so reach me at +1 (456) 555-{2000 + i} today") for i in range(12)]
    rows += [(20, "please write to admin@localhost, soon"), (22, "then write to @office_team now")]
    rows += [(30, "you reach me at (030) 555 1234, later"), (31, "reach me at 77x0143 now")]
    rows += [(34, "an invoice 12 +1 (456) 555-2001 came"), (35, "the invoice 030 555 came"), (36, "1 " * 20_000)]
    text = dict(rows)
    got = {r.doc_id: [(s.kind, text[r.doc_id][s.start : s.end]) for s in r.spans] for r in m.find_pii(docs_of(rows)).collect()}
    assert got[20] == [(0, "admin@localhost")] and got[22] == [(0, "office_team")]
    assert got[30] == [(3, "(030) 555 1234")]
    assert got[31] == [(3, "77x0143")]
    assert got[34] == [(3, "+1 (456) 555-2001")] and got[35] == [] and got[36] == []


@pytest.mark.parametrize("schema", ["doc_id long, text string", "doc_id long, text string, spans int, t string, row_id long"])
def test_empty_nulls_and_repeats(docs_of, schema):
    extra = (1, "u", 2) if "spans" in schema else ()
    assert m.find_pii(docs_of([], schema)).count() == 0
    rows = m.find_pii(docs_of([(None, "q@w.e", *extra), (1, "q@w.e", *extra), (1, "q@w.e", *extra), (1, None, *extra)], schema)).collect()
    assert sorted(len(r.base) for r in rows) == [0, 1, 1, 1]


def test_one_word_and_right_hand_contexts_long_words_and_secrets(docs_of):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("bcdfghklmnprst") for _ in range(9))
    token = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(39)) + "a1"
    rows = [(i, f"{word()} callme +1 (456) 555-{2000 + i} {word()}") for i in range(8)] + [(20, f"{word()} callme 555x0142 {word()}")]
    rows += [(30 + i, f"{word()} {word()} u{i}@mail.example onlymail {word()}") for i in range(8)] + [(50, f"{word()} {word()} admin@localhost onlymail")]
    long = "w" * 300
    rows += [(60 + i, f"{long} mark{word()[0] * 3} is +1 (456) 555-{3000 + i} {word()}".replace("mark" + "b" * 3, "x")) for i in range(3)]
    rows += [(70 + i, f"{long} line 10.1.2.{i} {word()}") for i in range(5)] + [(80, f"{long} line 7x77.9 {word()}")]
    secrets = [token() for _ in range(6)]
    rows += [(90 + i, f'{word()} token = "{x}" {word()}') for i, x in enumerate(secrets)] + [(97, f'{word()} token = "s3cr3t" {word()}')]
    rows += [(98, f"{word()} {token()} {word()}")]  # nothing leads to it
    text = dict(rows)
    got = {r.doc_id: [(m.ALL_KINDS[s.kind], text[r.doc_id][s.start : s.end]) for s in r.spans] for r in m.find_pii(docs_of(rows)).collect()}
    assert got[20] == [("phone", "555x0142")] and got[50] == [("email", "admin@localhost")]
    assert got[80] == [("ip", "7x77.9")]
    assert [got[90 + i] for i in range(6)] == [[("secret", x)] for x in secrets] and got[97] == [("secret", "s3cr3t")]
    assert got[98] == []
