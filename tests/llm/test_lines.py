import pytest

from dimflow.llm import lines
from tests.llm.data import documents, empty, frame

SCHEMA = "doc_id LONG, text STRING, n_lines STRING"


def brute(rows, min_words):
    """Every line in a run of at least ``min_words`` words that also begins earlier goes."""
    place = [(d, k, i, x) for d, t, k in rows for i, x in enumerate((t or "").split("\n")) if x.strip(" ")]
    runs, gone = {}, set()
    for a in range(len(place)):
        words = 0
        for b in range(a, min(len(place), a + 60)):
            if place[b][1] != place[a][1]:
                break
            words += place[b][3].count(" ") + 1
            if words >= min_words:
                key = tuple(p[3] for p in place[a:b + 1])
                if runs.setdefault(key, a) < a:
                    gone.update(place[c][1:3] for c in range(a, b + 1))
    return {(d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in gone))
            for d, t, k in rows}


@pytest.mark.parametrize("min_words", [1, 10, 25])
def test_runs_as_by_brute_force(spark, min_words):
    rows = sorted({(r[0], r[1]) for r in documents()}, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    rows = [r for r in rows if r[0] is not None]
    rows += [(900, "a b\nc d e\nf\na b\nc d e\nf"), (901, "x\n\na b\n\nc d e\nf\ny"), (902, "f\nf\nf\nf\nf\nf\nf\nf\nf\nf\nf\nf\nf")]
    found = lines.without_repeated_runs(spark.createDataFrame([(*r, "?") for r in rows], SCHEMA).repartition(4), min_words)
    assert found.columns == ["doc_id", "text", "n_lines", "n_removed"]
    assert {(r.doc_id, r.text) for r in found.collect()} == brute([(*r, k) for k, r in enumerate(rows)], min_words)
    for r, (_, text) in zip(sorted(found.collect(), key=lambda r: r.doc_id), sorted(rows)):
        assert r.n_lines == (0 if text is None else text.count("\n") + 1)


def test_rows_alike_come_out_alike(spark):
    text = "one two three four five six seven eight nine ten\nmore"
    rows = [(1, text), (1, text), (2, text), (None, text), (None, None)]
    found = lines.without_repeated_runs(spark.createDataFrame(rows, "doc_id LONG, text STRING"))
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r.doc_id, []).append((r.text, r.n_removed))
    assert by_id[None] == [(text, 0), (None, 0)] or by_id[None] == [(None, 0), (text, 0)]
    assert by_id[1] == [("", 2)] * 2 and by_id[2] == [("", 2)]


def test_other_columns_and_empty_tables(spark):
    found = lines.without_repeated_runs(frame(spark))
    assert found.columns[:8] == frame(spark).columns and found.count() == frame(spark).count()
    assert lines.without_repeated_runs(empty(spark)).count() == 0


def test_only_dataframe_operations(spark, capsys):
    lines.without_repeated_runs(frame(spark)).explain()
    assert not any(w in capsys.readouterr().out for w in ("Python", "Pandas", "Arrow"))
