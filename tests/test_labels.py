"""Annotation rules (E18, E19, E20) and the label job."""

import os

import pytest

from glyphlex.functions import labels as L
from glyphlex.operators import labels as LJ
from glyphlex.sources import io

RULES_A = [
    ("有络腮胡子的男人", "有络腮胡子"), ("微笑的猫", "微笑的猫"), ("旗: 中国", "中国"),
    ("挥手: 较浅肤色", "挥手"), ("挥手: 中等-深肤色", "挥手"), ("戴眼镜的脸", "脸"),
    ("滑雪者", "滑雪"), ("男生瑜伽", "瑜伽"), ("人", "人"), ("OK手势", "OK"),
]
RULES_B = [
    ("嘿嘿 | 脸 | 笑脸", "嘿嘿 "), ("男|男人", "男人"), ("笑脸的猫 | 猫", " 猫"),
    ("非常非常长的 | 短", " 短"), ("禁止非机动车 | 车", "禁止非机动车 "), ("人", None),
    ("向上箭头", "向上"),
]


def run(spark, expr, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in df.select("i", expr.alias("x")).orderBy("i").collect()]


def test_rules_a(spark):
    got = run(spark, L.speech_label("t"), [a for a, _ in RULES_A])
    assert got == [b for _, b in RULES_A]


def test_rules_b(spark):
    got = run(spark, L.first_usable_alias("t"), [a for a, _ in RULES_B])
    assert got == [b for _, b in RULES_B]


def test_alias_list(spark):
    got = run(spark, L.alias_list("t"), ["狗 | 小狗 | 狗 | 人", "的"])
    assert got == [sorted(["狗", "小狗", "人"]), []]


def test_python_strip_semantics(spark):
    got = run(spark, L.py_strip("t"), ["　 a  ", "\x1fb\x85"])
    assert got == ["a", "b"]


XML = """<?xml version="1.0" encoding="UTF-8"?>
<ldml>
  <annotations>
    <annotation cp="🐶">狗 | 小狗 | 宠物</annotation>
    <annotation cp="🐶" type="tts">狗脸</annotation>
    <annotation cp="👋🏻" type="tts">挥手: 较浅肤色</annotation>
    <annotation cp="A">字母</annotation>
    <annotation cp="🧔‍♂️" type="tts">有络腮胡子的男人</annotation>
  </annotations>
</ldml>
"""
DERIVED = """<?xml version="1.0" encoding="UTF-8"?>
<ldml>
  <annotations>
    <annotation cp="🐶" type="tts">小狗</annotation>
  </annotations>
</ldml>
"""


@pytest.fixture
def xml_files(tmp_path):
    base = tmp_path / "base.xml"
    derived = tmp_path / "derived.xml"
    base.write_text(XML, encoding="utf-8")
    derived.write_text(DERIVED, encoding="utf-8")
    return str(base), str(derived)


def test_build_labels(spark, xml_files):
    base, derived = (io.read_annotations(spark, p) for p in xml_files)
    out = LJ.build_labels([base, derived])
    speech = [(r.key, r.value) for r in out["speech"].orderBy("rank").collect()]
    assert speech == [("🐶", "小狗"), ("👋🏻", "挥手"), ("🧔‍♂️", "有络腮胡子")]
    aliases = {r.key: r.texts for r in out["aliases"].collect()}
    assert aliases == {"🐶": sorted(["狗", "小狗", "宠物"])}


def test_positional_slice_and_rules_b(spark, xml_files):
    base = io.read_annotations(spark, xml_files[0])
    sliced = io.slice_annotations(base, 1, 3)
    assert [r.cp for r in sliced.orderBy("pos").collect()] == ["🐶", "👋🏻"]
    got = {r.key: r.value for r in LJ.first_alias_labels(base).collect()}
    # later annotations of the same symbol win; long aliases are skipped
    assert got["🐶"] == "狗脸"
    assert os.path.exists(xml_files[0])


def test_rules_b_trim_option(spark):
    got = run(spark, L.first_usable_alias("t", trim=True), ["嘿嘿 | 脸 | 笑脸", "笑脸的猫 | 猫"])
    assert got == ["嘿嘿", "猫"]
