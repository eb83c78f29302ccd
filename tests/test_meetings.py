"""The meeting operators on small synthetic material."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from turnloom.functions.text import has_han, masked, number_tokens
from turnloom.operators import decisions, edits, entities, notes, turns, validation
from turnloom.sources import materials, sinks
from turnloom.streaming import intake


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_labels_inline_preamble_and_full_width(spark):
    df = spark.createDataFrame([("a", "标题：甲。发言人2：一。发言人１：　二 "), ("b", "没有标签"), ("c", None), ("d", ""), ("e", "发言人3：发言人3：x")], "meeting_id string, body string")
    assert rows(turns.parse_turns(df)) == sorted([("a", 1, None, "标题：甲。"), ("a", 2, "2", "一。"), ("a", 3, "1", "二"), ("b", 1, None, "没有标签"), ("e", 1, "3", ""), ("e", 2, "3", "x")], key=str)


def test_anonymous_turns_follow_decisions(spark):
    bodies = spark.createDataFrame([("a", "你好再见"), ("b", "x")], "meeting_id string, body string")
    cuts = spark.createDataFrame([("a", 2), ("a", 2), ("a", 99)], "meeting_id string, begins int")
    assert rows(turns.anonymous_turns(bodies, cuts), "meeting_id", "turn_no", "text") == [("a", 1, "你好"), ("a", 2, "再见"), ("b", 1, "x")]


def test_packs_keep_turns_whole(spark):
    df = spark.createDataFrame([("m", k, "x" * n) for k, n in enumerate((3, 4, 5, 20, 1, 0))], "meeting_id string, turn_no long, text string")
    assert rows(turns.pack_turns(df, 8), "turn_no", "pack_no", "used") == [(0, 1, 3), (1, 1, 7), (2, 2, 5), (3, 3, 20), (4, 4, 1), (5, 4, 1)]
    assert turns.pack_turns(df.limit(0), 8).count() == 0


def test_units_are_not_split(spark):
    df = spark.createDataFrame([("m", k, n) for k, n in enumerate((2, 2, 2, 2, 2))], "meeting_id string, turn_no long, size long")
    units = turns.qa_units(df, F.col("turn_no").isin(1, 3))
    assert rows(turns.pack_units(units, df, 6), "qa_no", "pack_no") == [(0, 1), (1, 1), (2, 2)]


def test_assembly_faults_and_text(spark):
    source = spark.createDataFrame([("m", k, "甲", t) for k, t in enumerate("一二三四")], "meeting_id string, turn_no long, speaker string, text string")
    back = spark.createDataFrame([("m", 1, 0, "edit", "壹", None), ("m", 2, 1, "delete", None, " "), ("m", 3, 0, "keep", None, None), ("m", 4, 9, "keep", None, None)], "meeting_id string, position long, turn_no long, action string, text string, reason string")
    got = edits.assembly_summary(source, back).first().asDict()
    assert got == {"n_turns": 4, "n_edits": 4, "n_missing": 2, "n_unknown": 1, "n_repeated": 1, "n_out_of_order": 1, "n_unreasoned": 1, "ok": False}
    names = spark.createDataFrame([("m", "壹", "一号")], "meeting_id string, surface string, form string")
    assert edits.assembled(source, back, names).first()["text"] == "甲: 一号"


def test_decisions(spark):
    repairs = spark.createDataFrame([("ok", "甲乙丙", "甲丁丙", "乙", "丁", ["戊"]), ("gone", "甲", "丁", "乙", "丁", []), ("added", "甲乙", "甲丁戊", "乙", "丁", ["戊", "甲"])], "repair_id string, source string, edited string, old_span string, new_span string, forbidden array<string>")
    assert rows(decisions.repair_violations(repairs)) == [("added", "forbidden addition"), ("gone", "span not in source")]
    pairs = spark.createDataFrame([(1, "涨了12.6个点", "涨了12.6%"), (2, "一九年", "2019年"), (3, "３万", "3万")], "id int, source string, edited string")
    assert rows(decisions.number_additions(pairs), "id") == [(1,), (2,)]
    assert rows(decisions.number_additions(pairs, F.array(F.lit("2019"))), "id") == [(1,)]
    assert rows(decisions.lost_fragments(pairs.withColumn("fragments", F.array(F.lit("涨了")))), "id") == [(2,), (3,)]
    units = spark.createDataFrame([(1, "涨了12.6个点", "涨了12.6个百分点"), (2, "5亿元", "5亿美元"), (3, "６万台", "6万台")], "id int, source string, edited string")
    assert rows(decisions.quantity_changes(units), "id", "added") == [(1, ["12.6个百分点"]), (2, ["5亿美元"])]
    years = spark.createDataFrame([(1, "一九年", "2019年", True), (2, "一九年", "1918年", True), (3, "一九年", "2019年", None), (4, "一九个月", "2019年", True), (5, None, None, True), (6, "８７年", "1987年底", True)], "decision_id int, spoken string, written string, certain boolean")
    assert rows(decisions.year_faults(years)) == [(2, "other digits"), (3, "context leaves a doubt"), (4, "no two-digit year"), (5, "no two-digit year")]
    metrics = spark.createDataFrame([(1, "每股分红后的现金，以下叫分金", "每股分红后的现金", "分金", "分现金"), (2, "分金", "每股分红后的现金", "分金", "分现金"), (3, "分金即每股分红后的现金", "每股分红后的现金", "分金", "分现金"), (4, "每股分红后的现金，分金", "每股分红后的现金", "分金", "金分")], "decision_id int, sentence string, definition string, short string, restored string")
    assert rows(decisions.metric_faults(metrics)) == [(2, "no definition"), (3, "not behind its definition"), (4, "not of the definition")]
    minutes = spark.createDataFrame([(1, "ab", "ab"), (2, "abc", "ab"), (3, None, "ab"), (4, "a", None)], "id int, minutes string, reference string")
    assert rows(decisions.longer_minutes(minutes), "id") == [(2,), (3,), (4,)]
    faults = spark.createDataFrame([("a", "genuinely_doubtful", 0), ("b", "preserve_source", 0), ("c", "other", 1)], "candidate_id string, disposition string, doubtful_items int")
    assert rows(decisions.disposition_faults(faults)) == [("a", "doubtful items do not fit"), ("c", "unknown disposition")]
    changes = spark.createDataFrame([(1, "scope"), (2, "scope"), (3, "grammar")], "change_id int, kind string")
    assert rows(decisions.unproven_changes(changes, spark.createDataFrame([(2, True), (1, False)], "change_id int, in_meeting boolean"))) == [(1,)]


def test_order_of_turns_that_say_the_same(spark):
    said = spark.createDataFrame([("m", 1, "yes"), ("m", 2, "no"), ("m", 3, "yes")], "meeting_id string, turn_no long, text string")
    bodies = spark.createDataFrame([("m", "same", "yes no yes"), ("m", "once", "yes no"), ("m", "back", "no yes"), ("m", "none", "")], "meeting_id string, source_id string, body string")
    found = {r["source_id"]: (round(r["coverage"], 2), r["in_order"]) for r in turns.body_metrics(bodies, said).collect()}
    assert found == {"same": (1.0, True), "once": (1.0, False), "back": (1.0, False), "none": (0.0, True)}


def test_packs_of_a_very_long_meeting(spark):
    df = spark.range(64_000).selectExpr("'m' AS meeting_id", "id AS turn_no", "cast(id % 7 as int) AS size")
    found = turns.pack_turns(df, 100, size=F.col("size")).groupBy("pack_no").agg(F.sum("size").alias("n"), F.max("used").alias("used")).collect()
    assert len(found) == max(r["pack_no"] for r in found) and all(r["n"] == r["used"] <= 100 for r in found) and sum(r["n"] for r in found) == sum(k % 7 for k in range(64_000))
    mixed = spark.createDataFrame([(None, 2, "abc"), (None, 1, None), ("a", 1, "abcd")], "meeting_id string, turn_no long, text string")
    assert rows(turns.pack_turns(mixed, 3)) == sorted([(None, 1, 0, 1, 0), (None, 2, 3, 1, 3), ("a", 1, 4, 1, 4)], key=str)


def test_entities(spark):
    catalog = spark.createDataFrame([("明泽光电", "600001.SH"), ("明择光电", "600002.SH"), ("短", None), ("双名", "1.A"), ("双名", "2.A")], "name string, code string")
    found = spark.createDataFrame([(1, "明泽光电"), (2, "600002"), (3, "明泽光"), (4, "长"), (5, "600001.SH"), (6, "双名"), (7, None)], "candidate_id int, surface string")
    assert rows(entities.exact_matches(found, catalog), "candidate_id", "code", "n_codes", "matched_by") == [(1, "600001.SH", 1, "name"), (2, "600002.SH", 1, "bare_code"), (5, "600001.SH", 1, "code"), (6, None, 2, "name")]
    assert rows(entities.near_matches(found, catalog), "candidate_id", "name", "distance") == sorted([(1, "明择光电", 1), (3, "明泽光电", 1), (4, "短", 1)], key=str)
    assert rows(entities.near_matches(found, catalog, 2), "candidate_id", "name", "distance") == sorted([(1, "明择光电", 1), (3, "明泽光电", 1), (3, "明择光电", 2), (4, "短", 1), (4, "双名", 2), (6, "短", 2)], key=str)
    proof = [(1, "role", "a", None, 1, True), (2, "name", "a", None, 1, False), (2, "code", "a", "1.SH", 1, True), (2, "role", "a", None, 1, True), (3, "self_correction", "b", None, 3, True), (3, "definition", "c", None, 1, True)]
    proof += [(4, "reading", "d", None, 1, False), (4, "repeated_name", "d", None, 1, True), (5, "reading", "d", None, 1, False), (6, "definition", "e", None, 1, False), (7, "definition", "e", None, 2, True), (7, "definition", "f", None, 2, True), (8, "near_name", "g", None, 9, True)]
    anchors = spark.createDataFrame(proof, "candidate_id int, kind string, form string, code string, precedence int, in_meeting boolean")
    everyone = spark.range(1, 9).selectExpr("cast(id as int) AS candidate_id", "'resolved_identity' AS disposition")
    assert rows(entities.resolved(anchors, everyone)) == [(2, "a", "1.SH"), (3, "b", None), (4, "d", None)]
    assert rows(entities.unanchored(everyone, anchors)) == [(1,), (5,), (6,), (8,)]
    ways = spark.createDataFrame([("重", "chong"), ("重", "zhong")], "char string, reading string")
    assert rows(entities.readings(spark.createDataFrame([(1, "重庆")], "candidate_id int, surface string"), ways)) == [(1, "chong 庆"), (1, "zhong 庆")]
    leaks = entities.leaks(spark.createDataFrame([(1, ["公司", "张三", "正文"])], "query_id int, terms array<string>"), spark.createDataFrame([("张三",)], "name string"), spark.createDataFrame([("公司",), ("张三",)], "term string"))
    assert rows(leaks) == [(1, "张三"), (1, "正文")]
    people = spark.createDataFrame([(1, "公司", False, True), (2, "张三", True, True), (3, "其他", False, False), (4, "?", None, True)], "candidate_id int, surface string, is_person boolean, changes_text boolean")
    variants = spark.createDataFrame([(1, "工司", "sound"), (2, "章三", "sound")], "candidate_id int, variant string, kind string")
    assert rows(entities.search_plan(people, variants)) == [(1, "公司 OR 工司", 1)]
    assert rows(entities.surplus_rounds(spark.createDataFrame([("m", 1), ("m", 2), ("n", 1)], "meeting_id string, round int"))) == [("m", 2)]


def test_notes_and_structure(spark):
    parts = spark.createDataFrame([("m", "reference", 0, "正文"), ("m", "minutes", 1, "二"), ("m", "minutes", 0, "一")], "meeting_id string, section string, ord long, md string")
    changed = notes.change_items(spark.createDataFrame([("m", 1, "甲", "乙", "代码"), ("m", 2, "丙", "丙", None)], "meeting_id string, turn_no int, old string, new string, evidence string"))
    note = notes.rendered(parts.unionByName(changed))
    assert note.first()["md"] == "## 会议纪要\n\n一\n二\n\n## 参考原文\n\n正文\n\n## 重要信息修改记录\n\n- 甲 → 乙（代码）\n"
    assert validation.structure_faults(note).count() == 0
    bad = spark.createDataFrame([("x", "## 参考原文\n## 会议纪要\n## 会议纪要\n## 别的"), ("y", None)], "meeting_id string, md string")
    assert rows(validation.structure_faults(bad)) == sorted([("x", "unknown", "别的"), ("x", "repeated", "会议纪要"), ("x", "misplaced", "会议纪要"), ("y", "missing", "会议纪要"), ("y", "missing", "参考原文")], key=str)


def test_scores_mask_required_phrases(spark):
    cases = spark.createDataFrame([("c", "眼下不能说已经见底，还要再看。", ["不能说已经见底"], ["不能说已经见底", "还要再看"], None, ["已经见底"])], "id string, source string, expected_minutes_required array<string>, expected_reference_required array<string>, minutes_may_remove array<string>, forbidden_additions array<string>")
    outputs = lambda m, r: spark.createDataFrame([("c", m, r)], "id string, minutes string, reference string")
    assert validation.score_density(cases, outputs("不能说已经见底", "不能说已经见底，但还要再看")).first()["passed"]
    assert not validation.score_density(cases, outputs("已经见底", "不能说已经见底，但还要再看")).first()["passed"]
    assert not validation.score_density(cases, outputs("不能说已经见底", "眼下不能说已经见底，还要再看。")).first()["passed"]
    assert spark.range(1).select(masked(F.lit("aab"), F.array(F.lit("a"), F.lit("aa"))).alias("x")).first()["x"] == "\x01b"


def test_doubtful_scores(spark):
    schema = "id string, source string, candidate string, expected_rendering string, expected_disposition string, expected_doubtful_items int, expected_external_search_rounds int, forbidden_additions array<string>"
    cases = spark.createDataFrame([("c", "甲和乙", "甲 / 丙", "保留甲并列疑", "genuinely_doubtful", 2, 1, ["确认"]), ("l", "甲", "甲", "丁", "genuinely_doubtful", 2, None, ["确认"])], schema)

    def passed(case, n, k, t):
        outputs = spark.createDataFrame([(case, "genuinely_doubtful", t, n, k)], "id string, disposition string, rendering string, doubtful_items int, search_rounds int")
        return validation.score_doubtful(cases, outputs).first()["passed"]

    assert passed("c", 2, 1, "甲") and passed("l", 2, 0, "写作丁")
    assert not any((passed("c", 1, 1, "甲"), passed("c", 2, 2, "甲"), passed("c", 2, 1, "确认甲"), passed("c", 2, 1, ""), passed("c", 2, 1, None), passed("c", 2, None, "甲"), passed("c", 2, 1, "丙"), passed("l", 2, 0, "甲")))


def test_shipped_cases(spark):
    """All cases of a folder of case files, named by TURNLOOM_CASES, against outputs that follow what they expect."""
    folder = os.environ.get("TURNLOOM_CASES")
    if not folder:
        pytest.skip("TURNLOOM_CASES names no folder of case files")
    doubtful = materials.read_doubtful_cases(spark, f"{folder}/doubtful*.json").where("expected_disposition IS NOT NULL")
    density = materials.read_density_cases(spark, f"{folder}/*density*.json")
    literal = ~F.col("expected_rendering").rlike(validation._INSTRUCTION)
    right = doubtful.select("id", F.col("expected_disposition").alias("disposition"), F.when(literal, F.col("expected_rendering")).otherwise(F.col("source")).alias("rendering"), F.col("expected_doubtful_items").alias("doubtful_items"), F.lit(1).alias("search_rounds"))
    scores = validation.score_doubtful(doubtful, right).agg(F.count(F.lit(1)), F.sum(F.col("passed").cast("int"))).first()
    assert tuple(scores) == (30, 30)
    assert validation.score_doubtful(doubtful, right.withColumn("rendering", F.lit(""))).where("passed").count() == 0
    both = density.select("id", F.concat(F.array_join("expected_minutes_required", "；")).alias("minutes"), F.concat(F.array_join("expected_reference_required", "；"), F.lit("。"), F.regexp_replace("source", "[。]", "；")).alias("reference"))
    found = {r["id"]: r for r in validation.score_density(density, both).collect()}
    assert len(found) == 9 and all(not r["minutes_missing"] and not r["reference_missing"] and not r["forbidden"] for r in found.values())


def test_phrases_without_blanks(spark):
    texts = spark.createDataFrame([(1, "今天会议很长"), (2, "a long benchmark passage here"), (3, None), (4, "")], "text_id int, text string")
    phrases = spark.createDataFrame([(1, "会议"), (2, "long benchmark passage"), (3, ""), (4, "今天会议很长很长")], "phrase_id int, phrase string")
    assert rows(validation.phrase_hits(texts, phrases)) == [(1, 1), (2, 2)]


def test_text_functions(spark):
    df = spark.createDataFrame([("增８.5%和3",), (None,), ("x",)], "t string")
    assert [r[0] for r in df.select(number_tokens(F.col("t"))).collect()] == [["8.5%", "3"], [], []]
    assert [r[0] for r in df.select(has_han(F.col("t"))).collect()] == [True, False, False]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.md").write_text("发言人1：你好\n", encoding="utf-8")
    assert materials.read_texts(spark, str(tmp_path / "a.md")).first()["body"] == "发言人1：你好\n"
    with zipfile.ZipFile(tmp_path / "a.docx", "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body><w:p><w:r><w:t>一</w:t><w:tab/><w:t>二</w:t></w:r></w:p><w:p/></w:body></w:document>')
    with zipfile.ZipFile(tmp_path / "box.docx", "w") as z:
        box = "<w:txbxContent><w:p><w:r><w:t>box</w:t></w:r></w:p></w:txbxContent>"
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:mc="http://schemas.openxmlformats.org/markup-compatibility/2006"><w:body><w:p><w:r><w:t>out</w:t><mc:AlternateContent><mc:Choice>{box}</mc:Choice><mc:Fallback>{box}</mc:Fallback></mc:AlternateContent><w:t>er</w:t></w:r></w:p></w:body></w:document>')
    assert materials.docx_text((tmp_path / "box.docx").read_bytes()) == "outer\nbox"
    (tmp_path / "box.docx").unlink()
    (tmp_path / "b.docx").write_bytes(b"no zip")
    assert [r["body"] for r in materials.read_docx(spark, str(tmp_path / "*.docx")).orderBy("path").collect()] == ["一\t二\n", None]
    (tmp_path / "c.json").write_text(json.dumps({"schema_version": "1", "description": "", "cases": [{"id": "x", "source": "s", "forbidden_additions": ["f"]}]}, indent=1))
    assert materials.read_density_cases(spark, str(tmp_path / "c.json")).first()["minutes_may_remove"] is None
    assert materials.read_doubtful_cases(spark, str(tmp_path / "c.json")).first()["forbidden_additions"] == ["f"]
    (tmp_path / "t.csv").write_text("name,code\n甲,000001.SZ\n甲,000001.SZ\n")
    assert rows(materials.read_catalog(spark, str(tmp_path / "t.csv"))) == [("甲", "000001.SZ")]
    assert materials.models_present(str(tmp_path), ("none",)) == {"none": False}
    note = spark.createDataFrame([("m/1", "## x")], "meeting_id string, md string")
    assert sinks.write_notes(note, str(tmp_path / "out")) == 1 and (tmp_path / "out/m%2F1.md").read_text() == "## x"
    both = spark.createDataFrame([("m/1", "a"), ("m_1", "b"), ("..", "c"), ("会", "d")], "meeting_id string, md string")
    assert sinks.write_notes(both, str(tmp_path / "out")) == 4 and sorted(p.read_text() for p in (tmp_path / "out").glob("*.md")) == list("abcd")
    with pytest.raises(FileExistsError):
        sinks.write_notes(note.unionAll(note), str(tmp_path / "out"))
    assert sinks.write_process(note, str(tmp_path / "process"), note.agg(F.count(F.lit(1)).alias("n"))) == '{"n":1}'
    assert not sinks.export_archive(note, str(tmp_path / "archive"), False) and not (tmp_path / "archive").exists()
    assert json.loads(sinks.validation_json(validation.structure_faults(note)))["n_faults"] == 3


def test_utf8(spark):
    df = spark.createDataFrame([("a", bytearray("会".encode())), ("b", bytearray(b"\xe4\xbc")), ("c", bytearray(b"x"))], "path string, content binary")
    assert rows(validation.utf8_check(df, require_cjk=True)) == [("a", True, True, True), ("b", False, False, False), ("c", True, False, False)]


def test_stream_intake(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/m1.txt").write_text("发言人1：一。发言人2：二。", encoding="utf-8")
    intake.turns_to(intake.body_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "meeting_id", "turn_no", "text") == [("m1", 1, "一。"), ("m1", 2, "二。")]
