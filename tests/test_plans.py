"""Plans: guards refuse, muting is idempotent and reversible, sections nest as they should."""

import pytest
from pyspark.sql import functions as F

from quire import schema
from quire.operators import layout
from quire.plans import rules
from quire.queries.fixtures import frame


def items(spark, rows):
    from quire.queries.fixtures import _document, _parse

    kind = _parse(schema.ITEMS)
    return spark.createDataFrame([tuple(r.get(f.name) for f in kind.fields) for r in _document("d", rows)], kind)


def muted(df):
    return sorted((r.item_idx, r.signal) for r in df.where("action = 'mute'").collect())


def test_section_ends_at_the_same_level_and_at_an_appendix(spark):
    rows = [("text", "References", 0, 2), ("text", "[1]", 0), ("text", "Sub", 0, 3), ("text", "[2]", 0), ("text", "Next", 0, 2), ("text", "body", 0)]
    assert [i for i, _ in muted(layout.reference_plan(items(spark, rows)))] == [0, 1, 2, 3]
    rows = [("text", "Acknowledgments", 0, 1), ("text", "thanks", 0), ("text", "Appendix A. More", 0), ("text", "body", 0)]
    assert muted(layout.reference_plan(items(spark, rows))) == [(0, "acknowledgement"), (1, "acknowledgement")]


def test_a_heading_inside_a_section_opens_none_but_one_in_furniture_does(spark):
    rows = [("text", "References", 0, 1), ("text", "Acknowledgments", 0, 2), ("text", "x", 0), ("text", "End", 0, 1), ("text", "y", 0)]
    assert muted(layout.reference_plan(items(spark, rows))) == [(0, "reference"), (1, "reference"), (2, "reference")]
    rows = [("text", "References", 0, 2), ("header", "Funding", 0, 1), ("text", "x", 0), ("text", "Two", 0, 2), ("text", "y", 0), ("text", "One", 0, 1)]
    assert muted(layout.reference_plan(items(spark, rows))) == [(0, "reference"), (2, "acknowledgement"), (3, "acknowledgement"), (4, "acknowledgement")]


def test_level_zero_is_no_heading(spark):
    assert muted(layout.reference_plan(items(spark, [("text", "References", 0, 0), ("text", "x", 0)]))) == []


def test_mute_twice_and_revert(spark):
    base = frame(spark, "items")
    plan = rules.plan(base)
    once = rules.mute(base, plan)
    assert sorted(map(repr, rules.mute(once, plan).collect())) == sorted(map(repr, once.collect()))
    assert once.count() == base.count()
    shown = ["doc_id", "item_idx", "type", "text"]
    assert sorted(map(repr, rules.revert(once).select(shown).collect())) == sorted(map(repr, base.select(shown).collect()))


def test_guards(spark, tmp_path):
    base = frame(spark, "items")
    plan = rules.plan(base)
    with pytest.raises(rules.Refused, match="goes"):
        rules.guard(base, plan)
    rules.guard(base, plan, acknowledged=True)
    twice = plan.unionByName(plan.where("rule = 'reference'").withColumn("rule", F.lit("noise")))
    with pytest.raises(rules.Refused, match="more than one"):
        rules.guard(base, twice, acknowledged=True)
    with pytest.raises(rules.Refused, match="no such"):
        rules.guard(base, plan.withColumn("item_idx", F.col("item_idx") + 1000), acknowledged=True)
    out = rules.apply(base, plan, layout.chart_plan(base, frame(spark, "files")), acknowledged=True, path=str(tmp_path / "out"))
    assert out.count() == base.count() and out.where("orig_type = 'chart' AND type = 'image'").count() == 1


def test_patch_and_revert_a_missing_table(spark):
    base = frame(spark, "items")
    verified = spark.createDataFrame([("paper", 19, "<table><tr><td>1</td></tr></table>")], "doc_id string, item_idx int, value string")
    done = rules.patch(base, verified, "table_body", "2024-01-01")
    row = done.where("doc_id = 'paper' AND item_idx = 19").first()
    assert row.has_table_body and row.had_table_body is False and row.repaired_at == "2024-01-01"
    back = rules.revert(done).where("doc_id = 'paper' AND item_idx = 19").first()
    assert back.table_body is None and back.has_table_body is False


def test_latex_edits(spark):
    rows = [("equation", r"\mathrm { w i t h } x", 0), ("text", "no math", 0), ("equation", r"\alpha", 0)]
    got = rules.latex_edits(items(spark, rows)).collect()
    assert [(r.item_idx, r.field, r.words) for r in got] == [(0, "text", ["with"])]


def test_apply_keeps_a_backup_and_rolls_back(spark, tmp_path):
    base = frame(spark, "items")
    plan, path = rules.plan(base), f"file://{tmp_path}/corpus"
    base.write.parquet(path)
    before = spark.read.parquet(path)
    old = sorted(map(repr, before.collect()))
    out = rules.apply(before, plan, acknowledged=True, path=path)
    new = sorted(map(repr, out.collect()))
    assert new != old and sorted(map(repr, rules.rollback(spark, path).collect())) == old
    assert sorted(map(repr, rules.rollback(spark, path).collect())) == new  # undone as well
    with pytest.raises(rules.Refused, match="no backup"):
        rules.rollback(spark, f"file://{tmp_path}/nowhere")


def test_apply_leaves_the_target_when_what_was_written_is_wrong(spark, tmp_path, monkeypatch):
    base = frame(spark, "items")
    path = f"file://{tmp_path}/corpus"
    base.write.parquet(path)
    before = spark.read.parquet(path)
    old = sorted(map(repr, before.collect()))
    mute = rules.mute
    for wrong, why in ((lambda i, p: mute(i, p).where("item_idx <> 3"), "became"), (lambda i, p: mute(i, p).withColumn("orig_text", F.lit(None).cast("string")), "reverted")):
        monkeypatch.setattr(rules, "mute", wrong)
        with pytest.raises(rules.Refused, match=why):
            rules.apply(before, rules.plan(base), acknowledged=True, path=path)
        assert sorted(map(repr, spark.read.parquet(path).collect())) == old and not list(tmp_path.glob(".corpus.*"))
