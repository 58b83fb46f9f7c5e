"""Settled links are not gone through again."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame

from riskweave.llm import components


def test_links_inside_a_part_are_joined_once(spark, monkeypatch):
    # dense parts in a row, which take several rounds to become one
    parts = [list(range(100 * k + 3, 100 * k + 33)) for k in range(6)]
    pairs = [p for part in parts for p in combinations(part, 2)] + [(x[-1], y[-1]) for x, y in zip(parts, parts[1:])]
    ids = sum(parts, [])
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    made, join = [], type(links).join

    def counted(self: DataFrame, *rest, **named) -> DataFrame:
        out = join(self, *rest, **named)
        made.append(out.count())
        return out

    monkeypatch.setattr(type(links), "join", counted)
    found = components.connected_components(links)
    monkeypatch.undo()
    assert {(r["id"], r["label"]) for r in found.collect()} == {(i, 3) for i in ids}
    # both ends once, and a few rows for each id
    assert sum(made) <= 2 * links.count() + 10 * len(ids)
