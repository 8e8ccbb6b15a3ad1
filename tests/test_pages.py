"""Page folders and CSV with odd names, headers and line breaks."""

import pytest

from seriesmill.sources import readers


@pytest.fixture
def folder(tmp_path):
    folder = tmp_path / "my pages %20"
    folder.mkdir()
    return folder


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_paths_that_urls_would_escape(spark, folder):
    (folder / "a 1+é.csv").write_text("title,count\nA,1\n")
    (folder / "b#2.csv").write_text("count,title\n2,B\n")
    assert rows_of(readers.read_pages(spark, str(folder)), "title", "count") == [("A", "1"), ("B", "2")]


def test_quoted_line_breaks_quotes_and_commas(spark, folder):
    (folder / "a.csv").write_text('title,count\n"x\ny, ""z""",1\n\nplain,2\n')
    want = [('x\ny, "z"', "1"), ("plain", "2")]
    assert rows_of(readers.read_pages(spark, str(folder)), "title", "count") == sorted(want, key=repr)
    (folder / "b.csv").write_text('more,count,title\n"m\nm",3,"\n"\n')
    got = rows_of(readers.read_pages(spark, str(folder)), "title", "count", "more")
    assert got == sorted([(*w, None) for w in want] + [("\n", "3", "m\nm")], key=repr)
    path = str(folder / "a.csv")
    assert rows_of(readers.read_table(spark, path, multi_line=True), "title", "count") == sorted(want, key=repr)
    assert readers.read_table(spark, path).count() > 2


def test_headers_of_other_widths_marks_and_repeated_names(spark, folder):
    (folder / "a.csv").write_text("﻿title,count\r\nA,1\r\n", encoding="utf-8")
    (folder / "b.csv").write_text("count,title,extra,title\n2,B,e,second\n7\n")
    (folder / "c.csv").write_text('"title","co,unt"\nC,3\n')
    (folder / "d.csv").write_text("title,count\n")
    (folder / "e.csv").write_text("")
    (folder / "_SUCCESS").write_text("")
    df = readers.read_pages(spark, str(folder))
    assert rows_of(df, "title", "count", "extra", "`co,unt`") == sorted(
        [("A", "1", None, None), ("B", "2", "e", None), (None, "7", None, None), ("C", None, None, "3")], key=repr
    )
    assert readers.read_pages(spark, str(folder), max_rows=2).count() == 2


def test_many_files_in_one_task_keep_their_headers(spark, folder):
    for k in range(60):
        names = ["title", "count"] if k % 3 else ["count", "other", "title"]
        cells = {"title": f"t{k}", "count": str(k), "other": "o"}
        (folder / f"p{k:03d}.csv").write_text("\n".join([",".join(names), *[",".join(cells[n] for n in names)] * (k % 4)]) + "\n")
    got = rows_of(readers.read_pages(spark, str(folder)), "title", "count")
    assert got == sorted([(f"t{k}", str(k)) for k in range(60) for _ in range(k % 4)], key=repr)


def test_nothing_to_read(spark, folder):
    with pytest.raises(FileNotFoundError):
        readers.read_pages(spark, str(folder / "none"))
    (folder / "a.csv").write_text("title,count\n")
    assert readers.read_pages(spark, str(folder)).columns == ["title", "count"]
