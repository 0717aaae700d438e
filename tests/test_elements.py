"""Elements of stored pages by tag and class: nesting, sections, missing end tags."""

import pytest

from crease.sources import pages as PG

NESTED = """<html><!-- <table class="stats"><tr><td>no</td></tr></table> --><script>var t = "<table class='stats'>";</script>
<TABLE id=a class="wide stats"><thead><tr><th>Player<th>Runs</thead>
<tbody><tr><td>A <b>One</b></td><td title="x > y">10</td></tr><tr><td>(Team A)</td></tr>
<tr><td>B Two<td>20 <table class=inner><tr><td>deep <table><tr><td>deepest</td></tr></table></td></tr></table></td></tr>
<tr><td>(Team B)</td></tr></tbody><tfoot><tr><td>Total</td><td>30</td></tr></tfoot></TABLE>
<table class='other statsx'><tr><th>H</th></tr><tr><td>z</td></tr></table></table>
<table class="stats"><tr><td>never closed</td></tr>"""


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "https://x.org/2016/a", NESTED), (2, "https://x.org/b", None), (3, None, ""), (4, "u", "<p>no table</p>"),
            (5, "https://x.org/2011", "<table class=stats><tr><td>only</td></tr></table>"), (None, "u", "<table><tr><td>n</td></tr></table>")]
    return spark.createDataFrame([(*r, "e") for r in rows], "page_id long, url string, html string, element string")


def test_nested_elements_stand_apart(pages):
    got = {(r.page_id, r.element): r for r in PG.elements(pages).collect()}
    assert set(got) == {(1, 0), (1, 1), (1, 2), (1, 3), (5, 0), (None, 0)}        # the unclosed one is left out
    assert got[1, 0].classes == ["wide", "stats"] and got[1, 0].holds == [1] and got[1, 1].holds == [2] and got[1, 2].holds == []
    assert got[1, 1].classes == ["inner"] and got[1, 2].classes == [] and "deepest" not in got[1, 1].content
    assert {(r.page_id, r.element) for r in PG.elements(pages, classed="stats").collect()} == {(1, 0), (5, 0)}


def test_rows_of_the_chosen_table(pages):
    got = [(r.page_id, r.element, r.section, r.pos, r.cells) for r in PG.element_rows(pages, classed="stats").collect()]
    assert sorted(x for x in got if x[0] == 1) == [
        (1, 0, "body", 0, ["A One", "10"]), (1, 0, "body", 1, ["(Team A)"]), (1, 0, "body", 2, ["B Two", "20"]),
        (1, 0, "body", 3, ["(Team B)"]), (1, 0, "foot", 0, ["Total", "30"]), (1, 0, "head", 0, ["Player", "Runs"])]
    rest = sorted((r.element, r.section, r.pos, r.cells) for r in PG.element_rows(pages).where("page_id = 1 and element > 0").collect())
    assert rest == [(1, "body", 0, ["deep"]), (2, "body", 0, ["deepest"]), (3, "body", 0, ["z"]), (3, "head", 0, ["H"])]


def test_pairs_of_the_chosen_table(pages):
    got = sorted((r.page_id, r.pair, r.player, r.runs, r.team, r.season) for r in PG.element_pairs(pages, ["player", "runs"], "stats").collect())
    assert got == [(1, 0, "A One", "10", "Team A", 2016), (1, 1, "B Two", "20", "Team B", 2016), (5, 0, "only", None, None, 2011)]


def test_deep_and_broken_nesting(spark):
    deep = "<ul>" * 30 + "x" + "</ul>" * 30
    rows = [(1, deep), (2, "</ul><ul><li>a<ul><li>b</ul>"), (3, "<ul><li>" + "y" * 200_000 + "</ul>"), (4, "<ulx>a</ulx><ul\n>b</ul >")]
    df = spark.createDataFrame(rows, "page_id long, html string")
    got = PG.elements(df, "ul").collect()
    by = {i: sorted((r.element, r.holds) for r in got if r.page_id == i) for i in (1, 2, 3, 4)}
    assert by[1] == [(i, [i + 1] if i < 29 else []) for i in range(30)]
    assert by[2] == [(1, [])] and by[3] == [(0, [])] and by[4] == [(0, [])]
    assert {len(r.content) for r in got if r.page_id == 3} == {200_004}
    lists = PG.element_rows(df.where("page_id = 2"), tag="ul", row_tag="li", cell_tags=("li",)).collect()
    assert lists == [] and PG.elements(df.limit(0)).count() == 0


def test_no_shuffle(pages):
    plan = PG.element_rows(pages, classed="stats")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
