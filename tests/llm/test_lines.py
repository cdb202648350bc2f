"""Line dedup against comparing every line with every earlier one."""

import random
import re

from cabstar.llm import lines
from cabstar.llm.queries import op2_line_dedup

DOC = "doc_id long, text string"


def words(line):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def distance(a, b):
    """Word edits up to 2; more are 3 at least (only cells near the diagonal are filled)."""
    far = len(a) + len(b) + 3
    row = {j: j for j in range(min(len(b), 2) + 1)}
    for i, x in enumerate(a, 1):
        last, row = row, {}
        for j in range(max(0, i - 2), min(len(b), i + 2) + 1):
            same = last.get(j - 1, far) + (x != b[j - 1]) if j else i
            row[j] = min(last.get(j, far) + 1, row.get(j - 1, far) + 1, same)
    return row.get(len(b), far)


def brute(docs, least=2, fuzzy=8):
    """docs: (id, text) in order; equal rows count once."""
    seen, out = [], {}
    for key, text in docs:
        if (key, text) in out:
            continue
        kept, n = [], 0
        for line in (text or "").split("\n"):
            w = words(line)
            near = lambda o: o == w or (max(len(o), len(w)) >= fuzzy and abs(len(o) - len(w)) < 2 and distance(o, w) < 2)  # noqa: B023, E731
            if len(w) < least or not any(map(near, seen)):
                kept.append(line)
                n += len(w) >= least
            if len(w) >= least:
                seen.append(w)
        out[key, text] = (text and "\n".join(kept), n)
    return out


def corpus(seed):
    rng = random.Random(seed)
    base = [rng.choices("ab cd é fg h 12".split(), k=rng.randrange(1, 14)) for _ in range(12)]

    def line():
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i = rng.randrange(len(w) + 1)
            w[i : i + rng.randrange(2)] = rng.choices("abx", k=rng.randrange(2))
        text = rng.choice([" ", ", "]).join(w)
        return rng.choice([text, text.upper(), text + "."])

    return [(i, "\n".join(line() for _ in range(rng.randrange(9)))) for i in range(70)]


def test_equals_brute_force(spark, monkeypatch):
    for seed in range(3):
        monkeypatch.setattr(lines, "HOT_KEYS", [10_000, 100, 30][seed])  # few, some and no hot lines
        docs = [(-1, None), *corpus(seed), (900, ""), (901, "\n\n"), (902, "x" * 50_000)]
        docs.append((903, " ".join(map(str, range(20_000)))))
        docs.append((904, " ".join(map(str, [*range(9_000), "new", *range(9_000, 20_000)]))))
        table = spark.createDataFrame(docs, DOC).repartition(4)
        want = brute(docs)
        rows = lines.dedup_lines(table).collect()
        assert len(rows) == len(docs)
        texts = dict(docs)
        for r in rows:
            text, left = want[r.doc_id, texts[r.doc_id]]
            assert (r.text, r.n_left) == (text, left), (r.doc_id, texts[r.doc_id])
            assert r.n_lines - r.n_removed == (len(r.text.split("\n")) if r.text else 0) or not r.text
        assert any(r.text == "" and r.doc_id == 904 for r in rows)


def test_repeated_rows_null_ids_and_other_columns(spark):
    text = "one two three\nfour five six"
    rows = [(5, text, 1), (5, text, 2), (None, "one two three\nz", 3), (7, "Four five, six!\nlast one here", 4)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_left long")
    extra = table.withColumn("h", table["n_left"]).withColumn("key", table["n_left"])
    got = {r["key"]: r for r in lines.dedup_lines(extra, keep=("h", "key", "n_left")).collect()}
    assert got[1].text == got[2].text == "four five six"
    assert got[3].text == "one two three\nz" and got[3].doc_id is None
    assert got[4].text == "last one here" and (got[4].n_lines, got[4].n_removed, got[4].n_left) == (2, 1, 1)
    assert lines.dedup_lines(table.limit(0)).count() == 0


def test_many_lines_one_word_apart(spark):
    rows = [(i, f"seen page {i} of this long and boring list of pages") for i in range(500)]
    got = lines.dedup_lines(spark.createDataFrame(rows, DOC)).collect()
    assert sorted(r.doc_id for r in got if r.text) == [0]


def test_query(spark):
    rows = op2_line_dedup(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and sum(r.n_removed for r in rows) > 0


def test_lines_of_one_word(spark, tmp_path):
    long = ["これは空白のない一つの長い文です。", "x" * 70, "Heading"]
    rows = [(1, "\n".join(long)), (2, "\n".join([*long, "Other", "--"])), (3, "heading!\n--\n" + long[1])]
    docs = spark.createDataFrame(rows, DOC)
    got = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert got == {1: rows[0][1], 2: "Heading\nOther\n--", 3: "heading!\n--"}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_removed, r.n_left) for r in op2_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {1: (0, 3), 2: (3, 1), 3: (2, 0)}
