import hashlib
from collections import defaultdict

import cases

from ledgerstrata.llm.exact_dedup import drop_exact_copies, exact_groups


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[cases.lower(text)].append(doc_id)
    out = []
    for body, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(body).hexdigest()) for i in ids]
    return sorted(out, key=cases.key)


def found(df):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=cases.key
    )


def test_awkward_rows(spark):
    out = exact_groups(cases.documents(spark))
    assert found(out) == brute(cases.ROWS)
    # One row of each group stays, also where the largest id comes twice or is NULL.
    kept = [r for r in out.collect() if r.kept]
    assert len(kept) == len({r.text_sha256 for r in out.collect()}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_texts_that_part_at_every_digit(spark):
    base = cases.LONG[:9000]
    rows = [(i, base, "en", "a") for i in range(5)]
    for i, at in enumerate((0, 63, 64, 65, 4159, 4160, 4161, 8999)):
        changed = base[:at] + "é" + base[at + 2 :]  # the same number of bytes
        rows += [(10 + 2 * i, changed, "en", "a"), (11 + 2 * i, changed, "en", "a")]
    rows += [(90, base[:-1], "en", "a"), (91, base + "x", "en", "a")]
    docs = cases.documents(spark, rows)
    assert found(exact_groups(docs)) == brute(rows)
    assert found(exact_groups(docs, widths=(7,) * 3 + (2000,))) == brute(rows)


def test_empty_table(spark):
    assert exact_groups(cases.empty(spark)).collect() == []


def test_dropping_keeps_whole_rows(spark):
    docs = cases.documents(spark)
    out = drop_exact_copies(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len({cases.lower(text) for _, text, *_ in cases.ROWS})
    assert len({cases.lower(r.text) for r in rows}) == len(rows)
    assert all(r.kept == "given kept" for r in rows)
    assert sorted(r.doc_id for r in rows if r.text in ("one", cases.PROSE.upper())) == [2, 11]
