"""Literal pairs, properties and failure cases that SQL on the test tables does not show."""

import datetime as dt
import os
import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cellpub.functions import scalars
from cellpub.operators import contracts, cube, disclosure, joins, labels, quantiles, registers, survey
from cellpub.plans import quality
from cellpub.sources import scans, sinks, versions
from cellpub.sources.buckets import BucketTable
from cellpub.sources.versions import read_table
from cellpub.streaming.merge import merge_stream, windowed_counts


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("name", "out"),
    [("Saint-Oric-sur-Vell", "SAINT ORIC SUR VELL"), ("ST ORIC SUR VELL", "SAINT ORIC SUR VELL"), ("Storic", "STORIC"), ("Mérèville", "MEREVILLE"), ("L'Orée-Ste-Aube", "OREE SAINTE AUBE"), ("Vell Cedex 4", "VELL"),
     ("VELL CEDEXIA", "VELL CEDEXIA"), ("Cedex 9 Vell", ""), ("Precedex Vell", "PRECEDEX VELL"), ("Les Trois Puits", "TROIS PUITS"), ("Lesmont", "LESMONT"), (" - ", ""), (None, "")],
)
def test_normalize_name(spark, name, out):
    assert one(spark, scalars.normalize_name(F.lit(name).cast("string"))) == out


def test_dates_and_ids(spark):
    for text in ("31/12/1999", "1999-2-3", "1999-02-29", "1999-12-31 ", "", None):
        assert one(spark, scalars.strict_date(F.lit(text).cast("string"))) is None
    assert one(spark, scalars.strict_date(F.lit("1999-12-31"))) == dt.date(1999, 12, 31)
    ids = scalars.identifiers(F.array(*map(F.lit, ("111222333", "111 222 333", "12", "987-654-321"))))
    assert one(spark, ids) == ["111222333", "987654321"]
    assert one(spark, scalars.identifiers(F.array(F.lit("4 5")))) == []
    assert one(spark, scalars.identifiers(F.lit(None).cast("array<string>"))) == []
    assert one(spark, scalars.corrected_id(F.lit("GAZETTE C "), F.lit("1999007"), F.lit("0042"))) == "C199900742"
    assert one(spark, scalars.corrected_id(F.lit("GAZETTE C"), F.lit(None).cast("string"), F.lit("42"))) is None


def test_activity_text(spark):
    text = lambda *t: one(spark, scalars.activity_text(*[F.lit(x).cast("string") for x in t]))
    assert text(" NON Précisé\n", "  Baking\tof  bread ") == "Baking of bread"
    assert text("néant", None) is None and text("-", "x") == "-" and len(text("ab " * 200)) == 300


def test_notice_with_nothing(spark):
    names = [*registers.NOTICE_FIELDS, "listepersonnes", "listeetablissements", "jugement", "acte", "parutionavisprecedent"]
    raw = spark.createDataFrame([(None,) * len(names) + (None,), ("x",) * len(names) + (["1"],)], ", ".join(f"{n} string" for n in names) + ", registre array<string>")
    empty, odd = sorted(registers.flatten_notice(raw).collect(), key=lambda r: r.id or "")
    assert len(empty) == 21 and set(empty) == {None, 0}
    assert odd.town == "x" and odd.n_companies == 0 and odd.published is odd.previous_id is odd.activity is None


def test_sources_without_their_files(spark, tmp_path):
    known = spark.createDataFrame([("a", "1", "f"), ("b", "1", "f")], "source string, version string, filter string")
    spark.range(1).write.parquet(str(tmp_path / "a"))
    found = scans.sources_to_read(known, known, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})
    assert [r.source for r in found.collect()] == ["b"]


def test_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    assert sinks.write_typed(spark.range(5), path, "id long") == 5
    folders = set(os.listdir(path))
    with pytest.raises(Exception, match="broken"):
        sinks.write_typed(spark.range(5).withColumn("id", F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long"))), path, "id long")
    assert read_table(spark, path).count() == 5 and set(os.listdir(path)) == folders
    assert sinks.write_typed(spark.range(2), path, "id long") == 2 and read_table(spark, path).count() == 2


def test_rest_imports_without_llm(tmp_path):
    """What is left when the folders of the corpus operators are deleted still gives its queries."""
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "cellpub", tmp_path / "cellpub", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'monthly_fact' in q and set(o) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_months_to_read(spark):
    manifest = spark.createDataFrame([("1999-03", dt.date(1999, 4, 20)), ("1999-04", dt.date(1999, 5, 1))], "month string, extracted_at date")
    read = lambda start, force: sorted(r[0] for r in scans.months_to_read(spark, start, dt.date(1999, 6, 11), manifest, force=force).collect())
    assert read(dt.date(1999, 3, 1), False) == ["1999-04", "1999-05", "1999-06"]
    assert read(dt.date(1999, 5, 1), True) == ["1999-05", "1999-06"]


def test_first_of_object_or_list(spark):
    for text in ('{"person": {"n": "a"}}', '{"person": [{"n": "a"}, {"n": "b"}]}'):
        assert one(spark, scalars.first_of(scalars.tolerant_json(F.lit(text)), "person.n")) == "a"
    assert one(spark, scalars.first_of(scalars.tolerant_json(F.lit("{bad")), "person.n")) is None


def test_survey_header(spark):
    sheet = spark.createDataFrame([("x1", "*", "12")], "`Job Code` string, met string, `BE 26` string")
    row = scans.load_survey(sheet, {"job": "jobcode", "basin": r"be\d\d", "projects": "met"}, ["projects"], secret_of="projects").first()
    assert (row.job, row.basin, row.projects, row.secret) == ("x1", "12", None, True)
    with pytest.raises(ValueError, match="no column"):
        scans.load_survey(sheet, {"family": "family"}, [])


def test_guards(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        scans.non_empty(spark.range(0), str(tmp_path / "some"), "nothing")
    assert scans.non_empty(spark.range(3), str(tmp_path / "some"), "three") == 3
    with pytest.raises(ValueError, match="no rows"):
        scans.non_empty(spark.range(0), str(tmp_path / "some"), "nothing any more")
    assert read_table(spark, str(tmp_path / "some")).count() == 3  # the last good extract stays
    with pytest.raises(ValueError, match="parent"):
        scans.restrict_perimeter(spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("b",)], "k string"), "k")
    assert sinks.write_typed(spark.range(0), str(tmp_path / "typed"), "id int") == 0
    assert read_table(spark, str(tmp_path / "typed")).dtypes == [("id", "int")]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert sinks.logged(spark, path, "a", lambda: 7) == 7
    with pytest.raises(RuntimeError):
        sinks.logged(spark, path, "a", lambda: (_ for _ in ()).throw(RuntimeError("broken")))
    log = {r.status: r for r in contracts.latest_runs(spark.read.parquet(path)).collect()}
    assert log["ok"].rows == 7 and log["failed"].error == "broken"


def test_policy(spark):
    """Divisions by confidence, sections by mass, nothing where either is too small or the choice is none; ties of mass go to the smaller section."""
    hierarchy = spark.createDataFrame([("p1", "P"), ("p2", "P"), ("q1", "Q"), ("r1", "R")], "division string, section string")
    rows = [
        (10, "q1", 0.91, {"q1": 0.91, "p1": 0.05}), (11, "p1", 0.35, {"p1": 0.35, "p2": 0.5, "q1": 0.15}), (12, "r1", 0.4, {"r1": 0.4, "q1": 0.3, "p2": 0.3}), (13, labels.NONE, 1.0, {labels.NONE: 1.0}),
        (14, "q1", 0.2, {"q1": 0.45, "p1": 0.45}), (15, "nowhere", 0.95, {"nowhere": 0.95}),
    ]
    scored = spark.createDataFrame(rows, "id int, division string, confidence double, probabilities map<string,double>")
    found = {r.id: (r.level, r.division, r.section) for r in labels.hierarchical_decision(scored, hierarchy, 0.9, 0.8).collect()}
    assert found == {10: ("division", "q1", "Q"), 11: ("section", None, "P"), 12: ("none", None, None), 13: ("none", None, None), 14: ("none", None, None), 15: ("division", "nowhere", None)}
    low = {r.id: r.section for r in labels.hierarchical_decision(scored, hierarchy, 0.9, 0.4).collect()}
    assert low[14] == "P"
    truth = spark.createDataFrame([(10, "q1"), (11, "q1"), (12, "r1"), (15, "p1")], "id int, division string")
    # Of the best divisions two are right, of their sections too: that of 11 is P, whatever the heaviest section is.
    assert tuple(labels.forced_accuracy(scored, hierarchy, truth).first()) == (4, 0.5, 0.5)
    assert {(r.from_confidence, r.n, r.accuracy) for r in labels.calibration(scored, truth).collect()} == {(0.9, 2, 0.5), (0.3, 2, 0.5)}
    with pytest.raises(Exception, match="empty sample"):
        labels.forced_accuracy(scored, hierarchy, spark.createDataFrame([], "id int, division string")).collect()


def test_policy_is_rounded_to_three_decimals(spark):
    hierarchy = spark.createDataFrame([("p1", "P"), ("q1", "Q")], "division string, section string")
    scored = spark.createDataFrame([(i, "p1", 0.95, {"p1": 0.95}) for i in range(3)], "id int, division string, confidence double, probabilities map<string,double>")
    truth = spark.createDataFrame([(0, "p1"), (1, "p1"), (2, "q1")], "id int, division string")
    row = labels.policy_grid(scored, hierarchy, truth, spark.createDataFrame([(0.9, 0.8)], "t1 double, t2 double")).first()
    assert (row.share_division, row.precision_division, row.precision_section, row.share_none, row.precision) == (1.0, 0.667, None, 0.0, 0.667)


def test_sector_of_localised_events(spark):
    """A register's activity before a label; a label's section or division; neither; an activity that the hierarchy lacks; whether the parent is registered."""
    places = spark.createDataFrame([("A1", "10", "X"), ("A2", "10", "Y"), ("A3", "20", "Z"), ("A4", "30", "W"), ("A5", "30", "W")], "area string, code string, name string")
    events = [(1, "10", "X", "p"), (2, "10", "?", "q"), (3, "20", None, "r"), (4, None, None, "s"), (5, "30", "W", None), (6, "10", "Y", "t")]
    events = spark.createDataFrame(events, "event int, code string, name string, parent string")
    seats = spark.createDataFrame([("p", "A9", "a1"), ("q", "A8", None), ("s", None, "a2"), ("t", "A7", "a1")], "parent string, area string, activity string")
    parents = spark.createDataFrame([("p", "a2"), ("r", None), ("t", "gone")], "parent string, activity string")
    linked = registers.link_records(events, places, seats, parents)
    found = {r.event: (r.area, r.method, r.in_register, r.activity) for r in linked.collect()}
    assert found == {
        1: ("A1", "code_and_name", True, "a2"), 2: ("A8", "seat", False, None), 3: ("A3", "code", True, None), 4: (None, "none", False, "a2"), 5: (None, "none", False, None), 6: ("A2", "code_and_name", True, "gone"),
    }
    codes = spark.createDataFrame([("a1", "d1", "S1"), ("a2", "d2", "S2")], "activity string, division string, section string")
    labels_ = [(1, "division", "d1", "S1"), (2, "section", None, "S3"), (3, "division", "d9", "S9"), (6, "section", None, "S3")]
    labels_ = spark.createDataFrame(labels_, "event int, level string, label_division string, label_section string")
    found = {r.event: (r.sector_source, r.division, r.section) for r in registers.localised_events(linked, codes, labels_).collect()}
    assert found == {
        1: ("register", "d2", "S2"), 2: ("label_section", "S3_ND", "S3"), 3: ("label_division", "d9", "S9"), 4: ("register", "d2", "S2"), 5: ("none", "ZZ", "ZZ"), 6: ("register", "ZZ", "ZZ"),
    }


@pytest.mark.parametrize("bound", [10, 10_000])
def test_lookup_under_skew(spark, monkeypatch, bound):
    """One code on half of the rows, and rows without a code: no task gets much more than the others, and the join is the plain one."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", bound)
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 997)
    rows = spark.range(0, 40_000, 1, 8).select("id", key.alias("code"))
    table = spark.range(0, 990).select(F.col("id").alias("code"), (F.col("id") * 3).alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        found = joins.lookup(rows, table, ["code"])
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 4 * sizes[len(sizes) // 2]
        assert sorted(map(repr, found.select("id", "code", "value").collect())) == sorted(map(repr, rows.join(table, "code", "left").select("id", "code", "value").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_cube_of_ragged_indicators(spark):
    """Two indicators with other months each, one with types: cells, windows and relations are those of each."""
    day = lambda k: dt.date(2020 + k // 12, k % 12 + 1, 1)
    months = [("x", day(k), day(k).strftime("%Y-%m"), "final" if k < 25 else "provisional") for k in range(27)] + [("y", day(k), day(k).strftime("%Y-%m"), "final") for k in range(10, 23)]
    months = spark.createDataFrame(months, "indicator string, month date, period string, status string")
    windows = cube.trailing_windows(months)
    spans = {(r.indicator, r.window): r["n"] for r in windows.groupBy("indicator", "window").agg(F.count("*").alias("n")).collect()}
    assert spans == {("x", "2022-01"): 12, ("x", "2021-01"): 12, ("y", "2021-11"): 12}
    types = spark.createDataFrame([("y", "t1"), ("y", "other")], "indicator string, detail string")
    spec = cube.specification(spark.createDataFrame([("x",), ("y",)], "indicator string"), types)
    rng = random.Random(3)
    facts = [(i, day(k), rng.choice("ab"), "S1", rng.choice(["d1", "d2"]), rng.choice(["t1", None]) if i == "y" else None, rng.randint(1, 9)) for i in "xy" for k in range(30) for _ in range(3)]
    facts = spark.createDataFrame(facts, "indicator string, month date, area string, section string, division string, detail string, value long")
    areas = spark.createDataFrame([("a",), ("b",), ("c",)], "area string")
    sectors = spark.createDataFrame([("d1", "S1"), ("d2", "S1"), ("d3", "S2")], "division string, section string")
    cells = cube.densify(cube.cube_cells(facts, months, windows, spec), cube.skeleton(months, windows, spec, areas, sectors, types)).cache()
    n = {(r.indicator, r.ptype, r.level): r["n"] for r in cells.groupBy("indicator", "ptype", "level").agg(F.count("*").alias("n")).collect()}
    assert n == {
        ("x", "M", "T"): 27 * 4, ("x", "M", "S"): 27 * 2, ("x", "Y", "T"): 2 * 4, ("x", "Y", "S"): 2 * 4 * 2, ("x", "Y", "D"): 2 * 3,
        ("y", "M", "T"): 13 * 4, ("y", "M", "S"): 13 * 2, ("y", "M", "P"): 13 * 2, ("y", "Y", "T"): 4, ("y", "Y", "S"): 8, ("y", "Y", "D"): 3, ("y", "Y", "P"): 2,
    }
    members = cube.additive_relations(cells, sectors, windows, spec)
    assert cube.relation_gaps(members, cells).isEmpty()
    rels = {r.rel.split("|")[0] for r in members.where("indicator = 'x'").select("rel").distinct().collect()}
    assert rels == set(cube.RELATIONS) - set(cube.OF_TYPES)
    assert members.where("rel like 'months|y|2021-11|TOTAL|P|%'").count() == 2 * 13
    counted = members.groupBy("rel").agg(F.count_if("is_total").alias("totals"), F.count("*").alias("n"))
    assert counted.where("totals <> 1 or n < 2").isEmpty()


def test_cube_reads_its_cells_once(spark, tmp_path):
    names = ", ".join(f"{k} string" for k in cube.KEY)
    path = str(tmp_path / "cells")
    spark.createDataFrame([], f"{names}, value long").write.parquet(path)
    spec = cube.specification(spark.createDataFrame([("x",)], "indicator string"), spark.createDataFrame([], "indicator string, detail string"))
    members = cube.additive_relations(spark.read.parquet(path), spark.createDataFrame([], "division string, section string"), spark.createDataFrame([], "indicator string, window string, month date"), spec)
    assert members._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1


def synchronous(cells, members):
    """Masks by rounds over plain dicts: what secondary suppression is defined as."""
    masks = {k: "p" for k, v in cells.items() if 0 < v < disclosure.THRESHOLD}
    while True:
        new = set()
        for own in members.values():
            free = [(cells[k], k) for k in own if k not in masks and cells[k] > 0]
            if sum(k in masks for k in own) == 1 and free:
                new.add(min(free)[1])
        if not new:
            return masks
        masks |= dict.fromkeys(new, "s")


def size_of(path):
    return sum(f.stat().st_size for f in Path(path.removeprefix("file:")).rglob("*.parquet"))


def test_suppression_writes_what_it_masks(spark, monkeypatch):
    """A chain of relations in which each mask makes the next: the masks are those of the definition, and a round writes a small part of the table."""
    n, names = 12, ", ".join(f"{k} string" for k in cube.KEY)
    key = lambda i: ("x", "M", "p", f"g{i:05d}", "T", "ALL")
    cells = {key(i): 10 + i for i in range(3000)} | {key(0): 3}
    members = {f"r{i}": [key(i), key(i + 1), key(2000 + i)] for i in range(n)} | {f"z{i}": [key(i), key(i + 1)] for i in range(100, 1900)}
    written = []
    monkeypatch.setattr(disclosure, "kept", lambda df, name, f=disclosure.kept: (written.append((name, out := f(df, name))), out)[1])
    monkeypatch.setattr(disclosure, "counted", lambda df, name, f=disclosure.counted: (out := f(df, name), written.append((name, out[0])))[0])
    table = spark.createDataFrame([(*k, v) for k, v in cells.items()], f"{names}, value long").coalesce(1)
    long = spark.createDataFrame([(r, *k) for r, ks in members.items() for k in ks], f"rel string, {names}").coalesce(1)
    found = disclosure.secondary_suppression(disclosure.primary_suppression(table), long)
    masks = {tuple(r[k] for k in cube.KEY): r.mask for r in found.where("mask is not null").collect()}
    assert masks == synchronous(cells, members) and len(masks) > 8
    sizes = {name: size_of(df.inputFiles()[0].rsplit("/", 1)[0]) for name, df in written if name in ("cells", "members")}
    rounds = [df for name, df in written if name == "masks"]
    assert len(rounds) > 8 and all(df.count() <= 4 for df in rounds) and [name for name, _ in written].count("cells") == 1
    assert sizes["members"] > 20_000


@pytest.mark.parametrize(("bins", "few"), [(4, 3), (1024, 10_000)])
def test_exact_quantiles(spark, monkeypatch, bins, few):
    monkeypatch.setattr(quantiles, "BINS", bins)
    monkeypatch.setattr(quantiles, "FEW", few)
    rng = random.Random(1)
    fractions = [0.0, 0.2, 0.25, 0.5, 0.8, 0.999, 1.0]
    for values in ([5.0], [1.0, 2.0], [7.0] * 50 + [1e-300], [rng.expovariate(1) ** 9 for _ in range(301)], [rng.choice([-3.5, 0.0, 2.0]) for _ in range(200)], [-1.7e308, 1.7e308, 0.0, 1.0, 2.0]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
        want = df.agg(F.percentile("v", F.array(*map(F.lit, fractions)))).first()[0]
        assert quantiles.exact_quantiles(df, "v", fractions) == pytest.approx(want, rel=1e-12)
    assert quantiles.exact_quantiles(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]


def test_report_is_that_of_its_checks_in_one_pass(spark):
    sf = "/root/testdata/sf0.001"
    report = quality.QUERIES["check_report"](spark, sf)
    apart = {}
    for name, (severity, df) in quality.checks(spark, sf).items():
        v, n = df.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        apart[name] = (severity, v, n)
    assert {r.check: (r.severity, r.violations, r.failing_rows) for r in report.collect()} == apart
    plan = report._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 4  # lineitem, orders with customers, documents


def test_report_kinds(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "k string")
    right = spark.createDataFrame([("a",), ("d",), ("d",)], "k string")
    yes = F.lit(True)
    rules = [
        contracts.unique_rule("unique", "left", "k"), contracts.not_null_rule("not_null", "left", "k"), contracts.value_rule("values", "left", "k", F.col("k") < "c", "warn"),
        contracts.reference_rule("orphan", ("left", "k"), ("right", "k", yes)), contracts.reference_rule("uncovered", ("left", "k"), ("right", "k", yes), "uncovered"),
        contracts.reference_rule("empty", ("left", "k"), ("right", "k", F.col("k") != "x"), "empty"),
        contracts.Rule("differ", "error", "differ", (("left", "left", F.lit("n"), yes), ("right", "right", F.lit("n"), yes))), contracts.Rule("low", "error", "low", (("left", "left", F.col("k"), F.col("k").isNotNull()),), 1.5),
        contracts.unique_rule("fine", "left", F.concat("k", F.expr("uuid()"))),
    ]
    found = {r.check: (r.violations, r.failing_rows, r.status) for r in contracts.check_report({"left": left, "right": right}, rules, {"known": ("error", 2)}).collect()}
    assert found == {
        "unique": (1, 2, "fail"), "not_null": (1, 1, "fail"), "values": (1, 1, "warn"), "orphan": (2, 2, "fail"), "uncovered": (2, 2, "fail"), "empty": (1, 1, "fail"), "differ": (1, 2, "fail"),
        "low": (2, 2, "fail"), "fine": (0, 0, "pass"), "known": (2, 2, "fail"),
    }


def test_readers_and_writers_of_versions(spark, tmp_path):
    """At every step of a write readers find a whole table, and of two writers that saw the same version one makes the next."""
    root = str(tmp_path / "table")
    seen = []
    for k in range(1, 4):
        versions.replace(spark.range(k), root, lambda: seen.append(versions.read_table(spark, root).count() if versions.current(spark, root)[0] else None))
    assert seen == [None, 1, 2] and versions.read_table(spark, root).count() == 3
    number, content = versions.current(spark, root)
    versions.commit(spark, root, number, content)
    with pytest.raises(versions.Conflict):
        versions.commit(spark, root, number, content)
    assert versions.current(spark, root)[0] == number + 1

    def other() -> None:
        versions.replace(spark.range(50), root)

    with pytest.raises(versions.Conflict):
        versions.replace(spark.range(60), root, other)
    assert versions.read_table(spark, root).count() == 50
    assert len([f for f in os.listdir(root) if f.startswith("data-")]) <= 2  # the current one and that before


def test_publication_is_whole(spark, tmp_path):
    root = str(tmp_path / "site")
    sinks.publish_together({"a": spark.range(1), "b": spark.range(2)}, root, "run-1")
    broken = spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.publish_together({"a": spark.range(9), "b": broken}, root, "run-2")
    assert sinks.published(spark, root, "a").count() == 1
    sinks.publish_together({"a": spark.range(5)}, root, "run-3")
    assert (sinks.published(spark, root, "a").count(), sinks.published(spark, root, "b").count()) == (5, 2)


def test_merge_rewrites_few_buckets(spark, tmp_path):
    root = str(tmp_path / "orders")
    base = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table = BucketTable.create(base, root, ["k"], 40)
    before = {f: f.stat().st_size for f in Path(root).rglob("*.parquet")}
    delta = base.where(F.pmod(F.xxhash64("k"), F.lit(40)) == 7).limit(5).withColumn("v", F.lit("new")).withColumn("more", F.lit(1))
    keys = {r.k for r in delta.collect()}
    table.merge(delta)
    new = sum(f.stat().st_size for f in Path(root).rglob("*.parquet") if f not in before)
    assert new < sum(before.values()) / 10
    rows = {r.k: (r.v, r.more) for r in table.read().collect()}
    assert len(rows) == 20_000 and {k for k, v in rows.items() if v == ("new", 1)} == keys and all(v[1] is None for k, v in rows.items() if k not in keys)
    table.merge(delta.limit(0))
    table.merge(delta.limit(1).select(F.lit(-1).cast("long").alias("k"), F.lit("added").alias("v")))
    assert table.read().count() == 20_001 and table.read().where("v = 'new'").count() == len(keys)

    class Late(BucketTable):
        def _write(self, seen, *rest):
            table.merge(delta.limit(1).select(F.lit(-2).cast("long").alias("k"), F.lit("first").alias("v")))
            return super()._write(seen, *rest)

    with pytest.raises(versions.Conflict):
        Late(spark, root).merge(delta.limit(1).select(F.lit(-3).cast("long").alias("k"), F.lit("second").alias("v")))
    assert {r.k for r in table.read().where("k < 0").collect()} == {-1, -2}


def test_only_open_months_are_read(spark, tmp_path):
    path = str(tmp_path / "extract")
    rows = spark.range(0, 700).select("id", F.date_add(F.lit(dt.date(2020, 1, 1)), F.col("id").cast("int")).alias("day"))
    scans.write_by_month(rows, path, "day")
    months = spark.createDataFrame([("2020-03",), ("2021-02",), ("2019-01",)], "month string")
    found = scans.read_months(spark, path, months, "2020-01")
    assert found.count() == 31 + 28 and {r.month for r in found.select("month").distinct().collect()} == {"2020-03", "2021-02"}
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    scans.write_by_month(rows.where("month(day) = 3").limit(4), path, "day")  # replaces March 2020 only
    assert spark.read.parquet(path).count() == 700 - 31 + 4 or spark.read.parquet(path).count() == 700 - 62 + 4


def scanned(df):
    """Rows that the scans of a query gave, by its plan."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        if node.nodeName() == "AdaptiveSparkPlan":
            walk(node.executedPlan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


def test_slices_of_clustered_extracts_skip_row_groups(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 4).select(F.lpad((F.xxhash64("id") % 1000 + 1000).cast("string"), 5, "0").alias("area"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    rows.write.parquet(str(tmp_path / "plain"))
    scans.write_clustered(rows, str(tmp_path / "clustered"), "area", 256 << 10)
    slice_ = lambda name: scans.extract_slice(spark.read.parquet(str(tmp_path / name)), ["area", "v"], "area", ["0011", "0012"])
    plain, clustered = slice_("plain"), slice_("clustered")
    assert sorted(plain.collect()) == sorted(clustered.collect())
    assert scanned(slice_("clustered")) * 3 < scanned(slice_("plain"))


def test_name_lists_are_cut_before_the_shuffle(spark):
    zoning = spark.range(5000).select(F.col("id").cast("string").alias("area"), F.concat(F.lit("n"), "id").alias("name"), F.when(F.col("id") < 4900, "big").otherwise("small").alias("basin"))
    perimeter = zoning.where("area in ('1', '2', '4990') or area > '491'").select("area", F.lit(10).alias("population"))
    found = survey.basin_overlap(zoning, perimeter)
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    rows = {r.basin: r for r in found.collect()}
    assert rows["big"].outside is None and rows["small"].n_areas == 100 and (rows["small"].outside is None) == (rows["small"].n_outside > 20)


@pytest.mark.parametrize("seed", range(6))
def test_suppression_settles_on_random_tables(spark, seed):
    """A random table with both margins: the independent check finds nothing, masks never open, and totals stay whole."""
    rng = random.Random(seed)
    n, m = rng.randint(2, 5), rng.randint(2, 6)
    body = {(f"g{i}", f"s{j}"): rng.choice([0, 0, 1, 2, 4, 5, 8, 20]) for i in range(n) for j in range(m)}
    for i in range(n):
        body[f"g{i}", "ALL"] = sum(body[f"g{i}", f"s{j}"] for j in range(m))
    for s in [*(f"s{j}" for j in range(m)), "ALL"]:
        body["TOTAL", s] = sum(body[f"g{i}", s] for i in range(n))
    key = lambda g, s: ("x", "M", "p", g, "T" if s == "ALL" else "S", s)
    names = ", ".join(f"{k} string" for k in cube.KEY)
    cells = spark.createDataFrame([(*key(*k), v) for k, v in body.items()], f"{names}, value long")
    members = [(f"row {g}", *key(g, s), s == "ALL") for g, s in body] + [(f"column {s}", *key(g, s), g == "TOTAL") for g, s in body]
    members = spark.createDataFrame(members, f"rel string, {names}, is_total boolean")
    assert cube.relation_gaps(members, cells).isEmpty()
    masked = disclosure.secondary_suppression(disclosure.primary_suppression(cells), members)
    assert disclosure.verify_suppression(masked, members).isEmpty()
    assert masked.count() == cells.count()
    assert masked.where("mask = 'p' and not value between 1 and 4").isEmpty()


def test_verifier_sees_what_is_broken(spark):
    names = ", ".join(f"{k} string" for k in cube.KEY)
    cells = spark.createDataFrame([("x", "M", "p", "a", "T", "ALL", 3, None), ("x", "M", "p", "b", "T", "ALL", 9, "s"), ("x", "M", "p", "TOTAL", "T", "ALL", 12, None)], f"{names}, value long, mask string")
    members = cells.select(F.lit("r").alias("rel"), *cube.KEY, (F.col("geo") == "TOTAL").alias("is_total"))
    assert {r.violation for r in disclosure.verify_suppression(cells, members).collect()} == {"open small cell", "single masked member"}


def test_streams(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "table")
    spark.createDataFrame([(1, 10, 1), (2, 20, 1), (1, 11, 2)], "k int, v int, t int").coalesce(1).write.parquet(source)
    read = lambda: spark.readStream.schema("k int, v int, t int").parquet(source)
    merge_stream(read(), table, ["k"], "t", str(tmp_path / "cp")).awaitTermination()
    spark.createDataFrame([(2, 21, 3)], "k int, v int, t int").coalesce(1).write.mode("append").parquet(source)
    merge_stream(read(), table, ["k"], "t", str(tmp_path / "cp")).awaitTermination()
    assert sorted((r.k, r.v) for r in BucketTable(spark, table).read().collect()) == [(1, 11), (2, 21)] and BucketTable(spark, table).info()["batch"] == 1
    counts = windowed_counts(read().withColumn("at", F.timestamp_seconds("t")), "at", "10 seconds", "1 minute", "k")
    counts.writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start().awaitTermination()
    assert {(r.k, r.n) for r in spark.table("counts").collect()} == {(1, 2), (2, 2)}


def test_fixed_rows_are_a_local_relation(spark):
    from cellpub.sources.shared import fixed_rows

    rows = fixed_rows(spark, [("a", 1, None), (None, 2, 0.5)], "x string, n int, s double")
    assert [tuple(r) for r in rows.collect()] == [("a", 1, None), (None, 2, 0.5)]
    assert "LocalRelation" in rows._jdf.queryExecution().optimizedPlan().toString()
    assert fixed_rows(spark, [], "x string, n long").collect() == []
