import duckdb
import pytest

from gaugeworks.llm.line_rules import RULES_SQL, clean, line_rules
from tests.llm import cases

COLUMNS = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words lost_words base_failed kept".split()


def rows():
    out = []
    for i in range(12):  # a host whose pages share a header, and copies of one page
        body = cases.words(i, 30)
        out.append(cases.doc(i, f"Shared  HEADER line of {'the' if i % 2 else 'The'} host\n{body}", source="a"))
        out.append(cases.doc(100 + i, f"only here {cases.words(77, 20)}\nand there", source="a"))
        out.append(cases.doc(200 + i, "Shared header line of the host\nfew words of its own, ten or more all in all", source="b" if i < 5 else "a"))
    out.append(cases.doc(300, " ".join(["again and again it goes"] * 9), source="a"))
    page = "\n".join(f"Shared header line of the host\nown {i} words" for i in range(9))
    out += [cases.doc(310, page, source="a")] * 3 + [cases.doc(311, page + " and more of them here" * 9, source="a")]
    out.append(cases.doc(301, "a b c d e x a b c d e y a b c d e\nx\n \nx\n#$ %", source=None))
    return out + [(*r[:3], r[3] or "b", r[4]) for r in cases.odd(400) if r[0] != 408]


@pytest.mark.parametrize(("most", "share"), [(3, 50), (11, 20)])
def test_rules_equal_their_sql(spark, most, share):
    data = rows()
    got = line_rules(cases.with_extra(cases.frame(spark, data)), most, share).select(*COLUMNS).collect()
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", [(r[0], r[1], r[3]) for r in data])
    twin = con.execute(RULES_SQL.format(max_documents=most, max_lost_percent=share))
    names = [d[0] for d in twin.description]
    want = [tuple(r[names.index(c)] for c in COLUMNS) for r in twin.fetchall()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[COLUMNS.index("lost_words")] and w[-1] for w in want)


def test_clean_cuts_lines_and_drops_rejected(spark):
    docs = cases.with_extra(cases.frame(spark, rows()))
    got = clean(docs, 3, 50)
    assert got.columns == docs.columns and got.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    verdict = {r["doc_id"]: r["kept"] for r in line_rules(docs, 3, 50).collect() if r["doc_id"] is not None}
    out = {r["doc_id"]: r for r in got.collect() if r["doc_id"] is not None}
    assert set(out) == {i for i, kept in verdict.items() if kept}
    assert out[0]["text"] == cases.words(0, 30) and out[0]["n_chars"] == len(out[0]["text"])
    assert 300 not in out and 100 in out and out[100]["text"].endswith("and there")


def test_every_occurrence_of_a_line_is_lost(spark):
    data = [cases.doc(i, f"Share this page\n{cases.words(i, 30)}") for i in range(4)]
    page = "\n".join(f"Share this page\n{cases.words(50 + i, 2)}" for i in range(40))  # 120 of 200 words go
    less = "\n".join(f"Share this page\n{cases.words(150 + i, 4)}" for i in range(40))  # 120 of 280 words go
    data += [cases.doc(10, page), cases.doc(11, less), cases.doc(11, less), cases.doc(11, less)]
    out = [r["doc_id"] for r in clean(cases.frame(spark, data), 3, 50).collect()]
    assert sorted(out) == [0, 1, 2, 3, 11, 11, 11]
    rows = line_rules(cases.frame(spark, data), 3, 50).collect()  # the query's verdict is the stage's
    assert sorted(r["doc_id"] for r in rows if r["kept"]) == sorted(out)
    assert {r["lost_words"] for r in rows if r["doc_id"] in (10, 11)} == {120}


def test_empty_table(spark):
    docs = cases.frame(spark, [])
    assert line_rules(docs).collect() == [] and clean(docs).collect() == []
