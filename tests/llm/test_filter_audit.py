import re
from itertools import permutations

import numpy as np
import pytest

from quillstream.llm import filter_audit

HARD = ["", " ", "\x85é", "é" * 3 + " 漢字\t😀a", "A\x0bB\x1cC", "#", "a a a b", "Ä A", "x" * 5000 + " $", " ".join(f"w{i % 70}" for i in range(100)), " ".join(f"W{i}" for i in range(130)), " ".join(f"w{i}" for i in range(99)), " a b c"]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def fails(text):
    words = words_of(text)
    return "".join(
        f
        for f, bad in zip(
            "ABCD",
            (len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), bool(re.search(r"[#$%&*|]", text))),
            strict=True,
        )
        if bad
    )


def test_failures_of_hard_texts():
    data = "".join(HARD).encode()
    offsets = np.r_[0, np.cumsum([len(t.encode()) for t in HARD])]
    masks = filter_audit.failures(np.frombuffer(data, np.uint8), offsets)
    assert ["".join(f for k, f in enumerate("ABCD") if m >> k & 1) for m in masks] == [fails(t) for t in HARD]


def test_states_of_characters():
    text = "aé 漢😀\n"
    _, after = filter_audit.transduce(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    assert after.tolist() == [1, 2, 1, 0, 3, 2, 1, 4, 3, 2, 1, 0]


def test_span_table_verifies_equal_hashes():
    data = np.frombuffer(b"aabbaab", np.uint8)
    starts, ends, row = np.array([0, 2, 4, 6]), np.array([2, 4, 6, 7]), np.zeros(4, int)
    table = filter_audit.SpanTable(data, starts, ends, row)
    table.hashes[:] = 7  # all spans want one place
    assert table.insert().tolist() == [True, True, False, True]


def brute(docs, labels):
    judged = []
    for doc_id, lang, text in docs:
        text = text or ""
        copy = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, _, t in docs)
        of = [x for x in labels if x[0] == doc_id and doc_id is not None]
        judged.append((lang or "", fails(text) + "E" * copy, any(x[1] == 1 for x in of), any(x[2] == 1 for x in of)))
    rows = {}
    for part in {j[0] for j in judged}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [j for j in judged if j[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                out = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                redundant = sum(f in j[1] for j in gone)
                gone += out
                shapley[f] += len(out)
                unique = sum(j[1] == f for j in judged if j[0] == part)
                rows[part, "".join(order), step] = [len(left), len(out), redundant, unique, sum(j[2] for j in out), sum(j[3] for j in out)]
        for key, row in rows.items():
            if key[0] == part:
                row.append(shapley[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in rows.items()}


DOCS = [(k, ["en", "de", None, ""][k % 4], t) for k, t in enumerate(HARD)] + [(50, "en", None), (51, "de", ""), (3, "en", HARD[3]), (52, "en", HARD[3]), (52, "en", HARD[3]), (None, "en", HARD[3]), (2**53 + 1, "de", HARD[10])]
LABELS = [(0, 1, 0), (0, 0, 1), (3, 1, 1), (52, None, 1), (None, 1, 1), (51, 0, None), (8, 1, 0)]
FIELDS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_brute_force(spark):
    docs = spark.createDataFrame([(*d, "x", 1) for d in DOCS], "doc_id long, lang string, text string, part string, mask int")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.filter_audit(docs, labels).collect()
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[f] for f in FIELDS) for r in got} == brute(DOCS, LABELS)
    assert len(got) == 600 * 3


@pytest.mark.parametrize("rows", [[], [(1, None, None)]])
def test_audit_of_nothing(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.filter_audit(docs, labels).count() == 600 * len(rows)
