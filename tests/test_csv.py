"""A1: CSV edge rows read with the contract schema."""
import pytest

from cartwright.contracts import Column, TableContract
from cartwright.sources.csv import read_contract_csv

EDGE = TableContract("edge", "full", (Column("id", "integer"), Column("name", "text"), Column("days", "numeric")),
                     source_file="edge.csv")


def test_csv_edge_rows(spark, scratch):
    path = f"{scratch}/edge.csv"
    with open(path, "w") as fh:
        fh.write('id,name,days\n1,"a ""b"", c",\n2,,8.0\n4,"",9\n')
    got = sorted(tuple(r) for r in read_contract_csv(spark, path, EDGE).collect())
    assert [(i, n, None if d is None else int(d)) for i, n, d in got] == [(1, 'a "b", c', None), (2, None, 8),
                                                                          (4, None, 9)]


def test_csv_bad_record_aborts(spark, scratch):
    path = f"{scratch}/bad.csv"
    with open(path, "w") as fh:
        fh.write("id,name,days\nx,y,z\n")
    with pytest.raises(Exception):
        read_contract_csv(spark, path, EDGE).collect()


def test_texts_come_back_as_they_were(spark, scratch):
    """blanks around, quotes, separators, backslashes and line breaks."""
    from dataclasses import replace

    from cartwright.sources.csv import write_contract_csv
    c = replace(EDGE, multi_line=True)
    texts = ["  padded  ", "\ttab\t", 'a "quoted", b', "two\nlines", "\n", "back\\slash\\", '\\"', "'", "ü ✓", " "]
    rows = [(i, t, None) for i, t in enumerate(texts)] + [(99, None, None)]
    write_contract_csv(spark.createDataFrame(rows, c.schema()), f"{scratch}/t", c)
    got = {r.id: r.name for r in read_contract_csv(spark, f"{scratch}/t", c).collect()}
    assert got == {i: t for i, t, _ in rows}


def test_quoted_line_break_needs_the_contract_option(spark, scratch):
    from dataclasses import replace
    path = f"{scratch}/nl.csv"
    with open(path, "w") as fh:
        fh.write('id,name,days\n1,"one\ntwo",3\n')
    assert read_contract_csv(spark, path, replace(EDGE, multi_line=True)).first().name == "one\ntwo"
    with pytest.raises(Exception):
        read_contract_csv(spark, path, EDGE).collect()
