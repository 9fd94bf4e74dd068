import cases

from ledgerstrata.llm import licenses

MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
FILES = [
    (1, "a/LICENSE", f"Some title\n{MIT}\nand more"),
    (2, "a/b/c/x.py", "no word of it"),
    (3, "a/b/LICENCE.md", "all about cats, licence included"),
    (4, "a/b/own.py", f"# head\n{GPL.upper()}\ncode"),
    (5, "a/b/c/COPYING", GPL),
    (6, "a/b/c/d/y.py", None),
    (7, "ab/z.py", ""),
    (8, None, MIT),
    (9, None, None),
    (10, "top.txt", "x"),
    (11, "a/NOTICE", "Licensed under CC BY-NC 4.0."),
    (12, "a/b/c/x.py", "the same path again"),
    (12, "a/b/c/x.py", "the same path again"),
    (None, "a/q", cases.LONG),
    (13, "a/b/two.py", f"{MIT}\n{GPL}"),
    (14, "a/b/far.py", "It is licensed from the General under a version of events, said the public."),
]


def scan(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    from pyspark.sql import functions as F

    clash = "licence basis key id dir unit term weight n".split()
    return licenses.scan_licences(df.withColumns({c: F.lit("given") for c in clash}))


def test_own_and_inherited(spark):
    rows = scan(spark, FILES).collect()
    assert len(rows) == len(FILES)
    got = {r.doc_id: (r.licence, r.basis, r.from_dir) for r in rows}
    assert got[1] == ("MIT", "own", None) and got[5] == ("GPL-3.0", "own", None)
    assert got[4] == ("GPL-3.0", "own", None)
    # Nearest directory above; the file in a/b names no licence, so a/b gives none.
    assert got[2] == got[12] == got[6] == ("GPL-3.0", "inherited", "a/b/c")
    # Equally close licence files of a directory: the first by name.
    assert got[3] == got[14] == ("CC-BY-NC-4.0", "inherited", "a")
    assert got[None] == ("CC-BY-NC-4.0", "inherited", "a")
    assert got[7] == got[10] == got[9] == (None, "none", None)
    assert got[8] == ("MIT", "own", None)
    # Of equally close templates the first by name.
    assert got[13] == ("GPL-3.0", "own", None)
    assert scan(spark, []).collect() == []


def test_root_licence(spark):
    rows = scan(spark, [(1, "LICENSE", MIT), (2, "x", ""), (3, "a/b/y", ""), (4, "/abs/z", "")]).collect()
    assert {r.doc_id: r.licence for r in rows} == {1: "MIT", 2: "MIT", 3: "MIT", 4: "MIT"}


def test_cosines(spark):
    """Line cosines against plain vectors."""
    from collections import Counter

    rows, idf, other = licenses.template_weights()
    lines = [text for _, text in licenses.TEMPLATES] + ["Released under the MIT Licence, friends."]
    files = spark.createDataFrame(list(enumerate(lines)), "id long, text string").selectExpr(
        "id", "concat('f', id) AS path", "text"
    )
    listed = {r.key: r.id for r in files.selectExpr("id", "xxhash64(id, path, text) AS key").collect()}
    got = {listed[r.key]: (r.licence, r.cosine) for r in licenses.own_licences(files, 0.0).collect()}
    for at, line in enumerate(lines):
        bag = Counter(licenses.terms(line))
        weight = {t: n * idf.get(t, other) for t, n in bag.items()}
        norm = sum(w * w for w in weight.values()) ** 0.5
        score = Counter()
        for name, template, term, part in rows:
            score[name, template] += weight.get(term, 0) * part
        best = min((-round(v / norm, 6), name) for (name, _), v in score.items())
        assert got[at][0] == best[1] and abs(got[at][1] + best[0]) < 1e-5
        if at < len(licenses.TEMPLATES):
            assert got[at][0] == licenses.TEMPLATES[at][0]
