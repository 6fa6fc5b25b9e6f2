import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lanehouse.functions import columns as fn
from lanehouse.functions import masks
from lanehouse.operators import windows
from lanehouse.plans import capacity, monitor
from lanehouse.sources import readers


def value(spark, column, **row):
    return spark.range(1).select(*(F.lit(v).alias(k) for k, v in row.items())).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "line, expected",
    [
        ("  a  b\tc d e f", "c d f"),
        ("a b c", "c  "),
        ("", "  "),
    ],
)
def test_tokens(spark, line, expected):
    assert value(spark, fn.tokens("line", [3, 4, 6]), line=line) == expected


@pytest.mark.parametrize(
    "line, expected", [("a b  d", "b "), ("whole", "whole"), ("a ", ""), (" a b", "a b")]
)
def test_cut_spaces(spark, line, expected):
    assert value(spark, fn.cut_spaces("line", [2, 3]), line=line) == expected


def test_random_lines_against_plain_splits(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice("ab \t") for _ in range(rng.randrange(30))) for _ in range(400)]
    lines += ["  ", "a", " a b", "a\tb c"]
    rows = spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "n int, line string")
    got = rows.select(
        "n", fn.tokens("line", [1, 3, 4], "|").alias("t"), fn.cut_spaces("line", [2, 4]).alias("c")
    )
    for row in got.collect():
        words = lines[row.n].split()
        assert row.t == "|".join(words[i] if i < len(words) else "" for i in (0, 2, 3))
        parts = lines[row.n].split(" ")
        cut = " ".join(parts[i] for i in (1, 3) if i < len(parts))
        assert row.c == (cut if len(parts) > 1 else lines[row.n])


def test_words_stand_alone(spark):
    word = fn.has_word("line", "a-2019")
    assert value(spark, word, line="x a-2019 y")
    assert value(spark, word, line="a-2019")
    assert not value(spark, word, line="xa-2019")
    assert not value(spark, word, line="a-20191")


def test_rows_match_in_any_field(spark):
    contains = fn.row_contains(["a", "b"], "hpc")
    assert value(spark, contains, a="1", b="the hpc")
    assert not value(spark, contains, a="hp", b="c")


def test_paths(spark):
    assert value(spark, fn.base_name("p"), p="/a/b.txt") == "b.txt"
    assert value(spark, fn.base_name("p"), p="/a/b/") == ""
    assert value(spark, fn.join_path("a", "b"), a="/x", b="y") == "/x/y"
    assert value(spark, fn.join_path("a", "b"), a="/x/", b="y") == "/x/y"
    assert value(spark, fn.join_path("a", "b"), a="/x", b="/y") == "/y"
    assert value(spark, fn.stem("p"), p="/dags/dag1.py") == "dag1"
    assert value(spark, fn.stem("p"), p="/dags/dag1.pyc") == "dag1"


def test_first_or_self(spark):
    documents = spark.createDataFrame([('{"a":1}',), ('[{"a":2},{"a":3}]',)], "t string")
    first = fn.first_or_self(F.parse_json("t"))
    got = [r.v for r in documents.select(F.variant_get(first, "$.a", "int").alias("v")).collect()]
    assert got == [1, 2]


def test_one_to_below_one(spark):
    got = spark.createDataFrame([(-1,), (0,), (2,), (None,)], "n int").select(fn.one_to("n").alias("v"))
    assert [r.v for r in got.collect()] == [[], [], [1, 2], []]


def test_ages(spark):
    ages = spark.createDataFrame([(None,), (0,), (-4,), (1,), (90,)], "d int")
    assert [r.v for r in ages.select(fn.age_or_default("d").alias("v")).collect()] == [30, 30, 30, 1, 90]


def test_text_lines(spark):
    assert value(spark, fn.text_lines("t"), t="a\n\nb\n") == ["a", "", "b"]
    assert value(spark, fn.text_lines("t"), t="a\n\n") == ["a", ""]
    assert value(spark, fn.text_lines("t"), t="a") == ["a"]


def lines_of(spark, *texts):
    rows = [(f"f{n}", pos, line) for n, text in enumerate(texts) for pos, line in enumerate(text.split("\n"))]
    return spark.createDataFrame(rows, "file string, pos long, line string")


REPORT = """Job Id: 1.pbs
    Job_Name = hpc_a
    noise = 1
    job_state = R
Job Id: 2.pbs
    job_state = Q
Job Id: 3.pbs
    Job_Name = other
    job_state = R
    job_state = hpc"""


@pytest.mark.parametrize("span", [1, 2, 3, 1000, None])
def test_job_records(spark, span):
    lines = lines_of(spark, REPORT, "job_state = hpc_only")
    records = capacity.job_records(lines, ["file"], span=span).orderBy("file", "pos").collect()
    assert [(r.file, r.job_id, r.job_name, r.job_state) for r in records] == [
        ("f0", "1.pbs", "hpc_a", "R"),
        ("f0", "2.pbs", "hpc_a", "Q"),
        ("f0", "3.pbs", "other", "hpc"),
        ("f1", "", "", "hpc_only"),
    ]


@pytest.mark.parametrize("span", [1, 4, 16, None])
def test_carry_forward_random(spark, span):
    rng = random.Random(3)
    rows, expected = [], {}
    for file in "abc":
        last = None
        for pos in sorted(rng.sample(range(200), 60)):
            known = rng.choice([None, None, None, pos])
            last = known if known is not None else last
            rows.append((file, pos, known))
            expected[file, pos] = last
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "file string, pos long, x long")
    got = windows.carry_forward(frame, ["file"], "pos", ["x"], span)
    assert {(r.file, r.pos): r.x for r in got.collect()} == expected


def test_after_context_ends_with_the_file(spark):
    lines = lines_of(spark, "a\nhit\nb\nc\nhit\nhit\nd", "x\nhit")
    got = windows.after_context(lines, F.col("line") == "hit", ["file"]).orderBy("file", "pos")
    assert [(r.file, r.pos) for r in got.collect()] == [
        ("f0", 1), ("f0", 2), ("f0", 4), ("f0", 5), ("f0", 6), ("f1", 1),
    ]
    text = spark.createDataFrame([("a\nhit\nb\nc\nhit\nhit\nd",)], "t string")
    spots = text.select(F.inline(windows.context_of_text(F.col("t"), "hit"))).collect()
    assert [r.pos for r in spots] == [1, 2, 4, 5, 6]


@pytest.mark.parametrize("n, span", [(1, 64), (3, 64), (1, 1), (9, 4), (200, 64)])
def test_after_context_over_blocks(spark, n, span):
    rng = random.Random(n)
    rows = []
    for group in ("a", "b", None):
        hits = {rng.randrange(1000) for _ in range(12)} | {63, 64, 127, 999}
        rows += [(group, k, "hit" if k in hits else None if k % 7 == 0 else f"line {k}", k) for k in range(1000)]
    lines = spark.createDataFrame(rows, "file string, pos long, line string, _x long").repartition(5)
    got = windows.after_context(lines, F.col("line") == "hit", ["file"], n=n, span=span)
    assert got.columns == lines.columns
    spots = {(r[0], r[1]) for r in rows if r[2] == "hit"}
    expected = [r for r in rows if any((r[0], r[1] - back) in spots for back in range(n + 1))]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))


def test_after_context_moves_every_line_once(spark, tmp_path):
    lines_of(spark, "a\nhit\nb").write.parquet(str(tmp_path / "t"))
    lines = spark.read.parquet(str(tmp_path / "t"))
    plan = windows.after_context(lines, F.col("line") == "hit", ["file"])._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert "Join" not in physical
    assert physical.count("Exchange") == 1 and physical.count("FileScan") == 1


def test_sections(spark):
    def sections(text):
        cut = windows.sections_of_text(F.col("t"), lambda line: line.startswith("#"))
        return [tuple(s) for s in value(spark, cut, t=text)]

    assert sections("a\n#b\nc\n#d") == [(0, None, ["a"]), (1, "#b", ["#b", "c"]), (3, "#d", ["#d"])]
    assert sections("#b\nc") == [(0, "#b", ["#b", "c"])]
    assert sections("") == [(0, None, [""])]


def test_summary_rows_of_any_number(spark):
    rows, none = spark.range(30).selectExpr("id + 100 AS id"), spark.range(0)
    got = monitor.summary_rows(b=none, a=rows, c=rows.limit(1)).collect()
    in_a = sorted((r.position, r["row"]) for r in got if r.section == "a")
    assert in_a == [(k + 1, f'{{"id":{100 + k}}}') for k in range(30)]
    assert Counter(r.section for r in got) == {"a": 30, "c": 1}


def test_summary_totals(spark):
    rows = spark.createDataFrame([(1, 2), (3, None)], "x int, y int")
    document = monitor.summary_totals(a=(rows, ("x", "y")), b=(rows.limit(0), ("x",))).first().document
    assert json.loads(document) == {"a": {"rows": 2, "x": 4, "y": 2}, "b": {"rows": 0, "x": 0}}


def test_storage_lines(spark):
    lines = spark.createDataFrame(
        [
            ("h", "/dev/mapper/vol1  100 60   40 60% /data"),
            ("h", "  /dev/mapper/vol1 10 1 9 10% /more"),
            ("h", "/dev/sda 100 1 1 1% /"),
        ],
        "host string, line string",
    )
    quota = spark.createDataFrame(
        [("rds", "share-a\nLive 1 2 3 4 5 6 7 8 9 10 11 700 13 1000\nshare-b\nLive a b")],
        "host string, text string",
    )
    report = monitor.storage_report(
        monitor.disk_usage(lines, "vol1"), monitor.quota_usage(quota, "share-a")
    )
    got = {r.host: (r.used, r.avail, r.used_share) for r in report.collect()}
    assert got == {"h": (61, 49, round(61 / 110, 6)), "rds": (700, 300, 0.7)}


def test_job_dump_without_jobs(spark):
    documents = spark.createDataFrame(
        [('{"Jobs":{"1":{"Job_Name":"hpc","job_state":"Q"}}}',), ('{"Jobs":{}}',), ("{}",)], "value string"
    )
    assert [tuple(r) for r in readers.job_dump(documents).collect()] == [("1", "hpc", "Q")]


def test_masks(spark):
    mask = "Y150N1;I8N2;N2I8;Y150N1"
    assert value(spark, masks.index_len("m"), m=mask) == 16
    assert value(spark, masks.cycles("m"), m=mask) == 150 + 1 + 8 + 2 + 2 + 8 + 150 + 1
    parts = value(spark, masks.mask_segments("m"), m="Y150N1;N10")
    assert [tuple(p) for p in parts] == [(1, "Y", 150), (1, "N", 1), (2, "N", 10)]
