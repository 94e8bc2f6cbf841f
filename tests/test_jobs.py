"""Whole jobs on small files in the supported layouts, and the command line."""

from decimal import Decimal

import pytest

from helpers import rows
from tallywork import __main__ as shell
from tallywork.plans import jobs
from tallywork.sinks import run_stream

LINES = "1 2 3 \n2 1\n1 4\n4 1 3\n3 1\n6\n"
NAMES = '1 "ONE A"\n2 TWO\n3 THREE\n4 FOUR\n6 "SIX B"\n'


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("jobs")
    ratings = [(u, m, 5 if m < 4 else u % 5 + 1) for u in range(1, 41) for m in range(1, 7) if (u + m) % 4]
    (path / "ratings").write_text("".join(f"{u}\t{m}\t{r}\t{u * 10 + m}\n" for u, m, r in ratings))
    (path / "ratings1m").write_text("".join(f"{u}::{m}::{r}::0\n" for u, m, r in ratings))
    (path / "titles").write_bytes("".join(f"{m}|Café {m}|x||\n" for m in range(1, 6)).encode("latin-1"))
    (path / "titles1m").write_bytes("".join(f"{m}::Café {m}::x\n" for m in range(1, 6)).encode("latin-1"))
    (path / "friends").write_bytes(b"0,Uma,33,38\r\n1,Ann,13,2\r\n2,Bo,19,5\r\n3,Cy,19,6\r\n4,Di,20,1\r\n")
    (path / "people").write_bytes(b"userID,name,age,friends\r\n0,Uma,33,38\r\n1,Ann,13,2\r\n2,Bo,19,5\r\n3,Cy,19,6\r\n")
    (path / "weather").write_text("S,20310101,TMIN,-75,,,\nS,20310101,TMAX,10,,,\nT,20310101,PRCP,0,,,\n")
    (path / "orders").write_text("7,501,30.25\n8,502,60.5\n7,503,41.3\n")
    (path / "book").write_text("The cat, the dog.\n\nCat's Café\n")
    (path / "graph").write_text(LINES)
    (path / "names").write_text(NAMES)
    (path / "line").write_bytes("".join(f"{x * 0.5 - 3},{x}\r\n" for x in range(200)).encode())
    header = "﻿No,HouseAge,DistanceToMRT,NumberConvenienceStores,PriceOfUnitArea\r\n"
    houses = "".join(f"{n},{n % 40}.5,{n * 13 % 997}.25,{n % 11},{50 - n % 40 * 0.5}\r\n" for n in range(400))
    (path / "houses").write_bytes((header + houses).encode())
    logs = path / "logs"
    logs.mkdir()
    (logs / "a").write_text('a.b.c - - [05/Mar/2031:07:08:09 +0000] "GET /x HTTP/1.1" 200 5\nbad\n')
    return path


def test_counts(spark, folder):
    assert jobs.rating_histogram(spark, f"{folder}/ratings").columns == ["rating", "n"]
    assert jobs.popular_items(spark, f"{folder}/ratings", k=2).count() == 2
    named = jobs.popular_items(spark, f"{folder}/ratings", f"{folder}/titles").collect()
    assert {(r.movie_id, r.title) for r in named} == {(m, f"Café {m}") for m in range(1, 6)} | {(6, None)}


def test_keyed_aggregates(spark, folder):
    assert [tuple(r) for r in jobs.average_friends(spark, f"{folder}/people").collect()] == [
        (13, 2.0), (19, 5.5), (33, 38.0),
    ]
    assert jobs.average_friends(spark, f"{folder}/friends", header=False).count() == 4
    assert [tuple(r) for r in jobs.spend_by_customer(spark, f"{folder}/orders").collect()] == [
        (7, Decimal("71.55")), (8, Decimal("60.50")),
    ]
    assert rows(jobs.temperatures(spark, f"{folder}/weather")) == [("S", 18.5, 33.8)]
    assert rows(jobs.lowest_temperatures(spark, f"{folder}/weather")) == [("S", 18.5)]
    assert rows(jobs.highest_temperatures(spark, f"{folder}/weather")) == [("S", 33.8)]


def test_words(spark, folder):
    assert jobs.word_count(spark, f"{folder}/book").first()[:] == ("cat", 2)
    assert ("café", 1) in rows(jobs.word_count(spark, f"{folder}/book", mode="unicode"))


def test_graph(spark, folder):
    files = f"{folder}/graph", f"{folder}/names"
    assert rows(jobs.most_connected(spark, *files)) == [(1, 3, "ONE A")]
    assert rows(jobs.connected_once(spark, *files)) == [(2, 1, "TWO"), (3, 1, "THREE")]
    assert rows(jobs.least_connected(spark, *files)) == [(6, 0, "SIX B")]
    assert rows(jobs.least_connected(spark, *files, at_least=1)) == [(2, 1, "TWO"), (3, 1, "THREE")]
    assert rows(jobs.separation(spark, f"{folder}/graph", 2, 3)) == [(3, 2, 1)]


def test_people(spark, folder):
    assert [r.name for r in jobs.people_aged(spark, f"{folder}/friends").collect()] == ["Ann", "Bo", "Cy"]
    assert [r.name for r in jobs.people_below(spark, f"{folder}/people").collect()] == ["Ann", "Bo", "Cy"]
    assert rows(jobs.people_per_age(spark, f"{folder}/people")) == [(13, 1), (19, 2), (33, 1)]
    assert rows(jobs.people_older(spark, f"{folder}/people"))[0] == ("Ann", 23)


@pytest.mark.parametrize("suffix,sep", [("", "\t"), ("1m", "::")])
def test_similar_items(spark, folder, suffix, sep):
    files = f"{folder}/ratings{suffix}", f"{folder}/titles{suffix}"
    assert jobs.similar_items(spark, *files, 1, sep=sep).count() == 0
    pairs = jobs.item_pairs(spark, files[0], "jaccard", sep)
    assert {(1, 2), (1, 3), (2, 3)} <= {(r.item1, r.item2) for r in pairs.collect()}
    assert jobs.item_pairs(spark, files[0], sep=sep).count() == 15


def test_models(spark, folder):
    got = jobs.recommendations(spark, f"{folder}/ratings", f"{folder}/titles", 3, k=4).collect()
    assert len(got) == 4 and all(r.user_id == 3 for r in got)
    assert 60 < jobs.line_predictions(spark, f"{folder}/line").count() < 140
    assert jobs.price_predictions(spark, f"{folder}/houses").columns == ["prediction", "label"]
    assert dict(rows(jobs.price_metrics(spark, f"{folder}/houses")))["r2"] > 0.9


def test_streams(spark, folder):
    counted = run_stream(jobs.status_stream(spark, f"{folder}/logs"), "job_status")
    assert rows(counted) == [(200, 1), (None, 1)]
    assert run_stream(jobs.endpoint_stream(spark, f"{folder}/logs"), "job_endpoints").count() == 6


def test_splits_follow_the_file(spark, folder):
    lines = [tuple(map(int, line.split("\t"))) for line in (folder / "ratings").read_text().splitlines()]
    folds = {(r.user_id, r.movie_id): r.fold for r in jobs.rating_folds(spark, f"{folder}/ratings").collect()}
    size = len(lines) / 5
    assert [folds[u, m] for u, m, *_ in lines] == [int(i // size) + 1 for i in range(len(lines))]
    marked = jobs.rating_holdout(spark, f"{folder}/ratings", 2, 3)
    held = {(r.user_id, r.movie_id) for r in marked.filter("is_test").collect()}
    seen, expected = {}, set()
    for u, m, *_ in lines:
        seen[u] = seen.get(u, 0) + 1
        if 2 <= seen[u] <= 3:
            expected.add((u, m))
    assert held == expected


def test_command_line(spark, folder, capsys, monkeypatch):
    shell.main(["popular_items", f"ratings={folder}/ratings", "k=1"])
    assert "movie_id" in capsys.readouterr().out
    shell.main(["spend_by_customer", f"orders={folder}/orders", "ascending=true"])
    out = capsys.readouterr().out
    assert out.index("60.50") < out.index("71.55")
    with pytest.raises(SystemExit):
        shell.main(["nothing"])
