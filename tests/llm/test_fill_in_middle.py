import hashlib
import random
import re

import cases
import numpy as np

from ledgerstrata.llm import fill_in_middle as fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKS = ("<P>", "<S>", "<M>")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    head = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(head[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    form = "spm" if h[3] % 100 < 80 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(units), form, len(prefix), len(middle), output


def test_digests_equal_brute_force(spark):
    rng = random.Random(7)
    letters = [" ", " ", "\n", "\t", "\x0b", "\xa0", "a", "b", "é", "語", "😀", "<", "P>", "<S", ">"]
    rows = [(i, "".join(rng.choices(letters, k=rng.randrange(40))), "en", "a") for i in range(3000)]
    rows += cases.ROWS + [(i, f"a {mark} b", "en", "a") for i in range(5000, 5040) for mark in MARKS]
    docs = cases.documents(spark, rows).repartition(4)
    got = fim.middle_digests(docs)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = [(*brute(r[0], r[1])[:5], sha(brute(r[0], r[1])[5]), sha(r[1] or "")) for r in rows]
    assert sorted((tuple(r) for r in got.collect()), key=cases.key) == sorted(want, key=cases.key)
    assert len({w[2] for w in want}) == 3


def test_texts_and_other_columns(spark):
    docs = cases.documents(spark)
    made = fim.fill_in_middle(docs)
    assert made.columns[: len(docs.columns)] == docs.columns
    added = made.columns[len(docs.columns) :]
    assert added == ["n_", "form_", "prefix_chars_", "middle_chars_", "output_"]
    for row in made.select("doc_id", "text", *added, fim.restored_text("output_", "form_").alias("back")).collect():
        assert tuple(row[c] for c in ("doc_id", *added)) == brute(row.doc_id, row.text)
        assert row.back == (row.text or "")
    assert fim.middle_digests(cases.empty(spark)).collect() == []
    assert {r.form for r in fim.fill_in_middle(cases.documents(spark, clash=False), rate=0).collect()} == {"plain"}


def test_skip_list_reaches_every_rank():
    rng = random.Random(1)
    for n in (0, 1, 2, 5, 700):
        widths = np.array([rng.randrange(1, 9) for _ in range(n)], np.int64)
        units = fim.SkipList(widths)
        sums = np.r_[0, np.cumsum(widths)]
        assert [units.points_before(r) for r in range(n + 1)] == sums.tolist()
        for unit_width, point_width, _ in units.lanes:
            assert unit_width.sum() == n and point_width.sum() == sums[-1]
    sizes = [len(lane[0]) for lane in fim.SkipList(np.ones(100_000, np.int64)).lanes]
    assert len(sizes) > 6 and all(0.2 < b / a < 0.3 for a, b in zip(sizes, sizes[1:]) if b > 1000)


def test_units_across_blocks(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 7)
    rng = random.Random(2)
    for _ in range(2000):
        text = "".join(rng.choices([" ", "\n", "a", "b", "é", "語", "\x0c"], k=rng.randrange(50)))
        assert fim.unit_widths(text.encode()).tolist() == [len(u) for u in UNIT.findall(text)]
