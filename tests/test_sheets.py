import json
from collections import Counter

from lanehouse.operators import aggregates, sets
from lanehouse.plans import sheets

WIDE, NARROW = "Y150N1;I8N2;N2I8;Y150N1", "Y100N1;I6N2;N10;Y100N1"
# run, project, lane, mask, tag, samples: two groups in a lane, one tag with two masks, a project in two runs
SAMPLES = [
    ("r1", "alpha", 3, WIDE, "NA", 2),
    ("r1", "alpha", 3, NARROW, "NA", 4),
    ("r1", "alpha", 5, NARROW, "10X", 1),
    ("r1", "beta", 3, WIDE, "NA", 3),
    ("r2", "beta", 8, NARROW, "NA", 5),
]
# project_index, lane_index, group, group_index of each
PLACES = [(1, 1, "16_NA", 1), (1, 1, "6_NA", 2), (1, 2, "6_10X", 1), (2, 1, "16_NA", 1), (1, 1, "6_NA", 1)]


def formatted(spark):
    rows = [row[:5] for row in SAMPLES for _ in range(row[5])]
    samples = spark.createDataFrame(
        rows, "run string, project string, lane int, bases_mask string, tag string"
    )
    return sheets.formatted_sheets(samples)


def test_formatted_sheets(spark):
    got = formatted(spark).collect()
    assert tuple(formatted(spark).columns[1:]) == sheets.SHEET_COLUMNS
    expected = [
        (run, project, p, lane, k, mask, group, g, n, f"SampleSheet_{project}_{lane}_{group}.csv")
        for (run, project, lane, mask, _, n), (p, k, group, g) in zip(SAMPLES, PLACES, strict=True)
    ]
    assert sorted(tuple(r) for r in got) == sorted(expected)


def test_sample_groups(spark):
    got = [tuple(r) for r in sheets.sample_groups(formatted(spark)).collect()]
    assert sorted(got) == sorted(
        (row[0], p, k, g, row[5]) for row, (p, k, _, g) in zip(SAMPLES, PLACES, strict=True)
    )


def test_sheet_tasks(spark):
    tasks = sheets.sheet_tasks(formatted(spark)).collect()
    counts = Counter((r.run, r.project_index, r.lane_index, r.index_group_index) for r in tasks)
    assert counts == {
        (row[0], p, k, g): row[5] for row, (p, k, _, g) in zip(SAMPLES, PLACES, strict=True)
    }
    assert sorted(r.sample for r in tasks if r.run == "r2") == [1, 2, 3, 4, 5]


def test_nested_maps_become_rows(spark):
    rows = [(1, {2: {3: 4, 5: 6}, 7: {}}), (2, {}), (3, None)]
    frame = spark.createDataFrame(rows, "id int, lanes map<int, map<int, int>>")
    got = sets.expand_nested(frame, "lanes", ["lane", "grp"], "n").collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 3, 4), (1, 2, 5, 6)]


def test_fan_in_levels(spark):
    rows = spark.createDataFrame([("p", 1, 2), ("p", 2, 3), ("q", 1, 4)], "project string, lane int, n int")
    got = {
        (r.grouping, r.project, r.lane): r.n
        for r in aggregates.fan_in(rows, ["project", "lane"], "n").collect()
    }
    assert got == {
        (0, "p", 1): 2, (0, "p", 2): 3, (0, "q", 1): 4,
        (1, "p", None): 5, (1, "q", None): 4, (3, None, None): 9,
    }


def test_merged_document(spark):
    one = spark.createDataFrame([('{"x":1}',)], "document string")
    two = spark.createDataFrame([("[2]",)], "document string")
    assert json.loads(aggregates.merge_json(a=one, b=two).first().document) == {"a": {"x": 1}, "b": [2]}
