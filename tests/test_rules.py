"""Candidate forms of one word per ending, written out by hand; nothing here comes from the rule tables."""

import pytest
from pyspark.sql import functions as F

from lexitrack.functions.conjugation import CURRENT, FIRST, INTERIM
from lexitrack.functions.split import candidate_forms

CURRENT_FORMS = {
    "食べる": "食べ 食べて 食べた 食べない 食べます 食べれば 食べよう 食べられる 食べさせる 食べている 食べていた 食べてる 食べてた "
              "食べず 食べずに 食べたい 食べたら 食べたり 食べろ 食べれ 食べさせ 食べられ 食べなかった 食べません 食べながら 食べつつ",
    "書く": "書 書いて 書いた 書かない 書きます 書けば 書こう 書かず 書きたい 書いたら 書いたり 書け 書かなかった 書き 書か 書きながら",
    "泳ぐ": "泳 泳いで 泳いだ 泳がない 泳ぎます 泳げば 泳ごう 泳がず 泳ぎたい 泳いだら 泳いだり 泳げ 泳がなかった 泳ぎ 泳が 泳ぎながら",
    "話す": "話 話して 話した 話さない 話します 話せば 話そう 話さず 話したい 話したら 話したり 話せ 話さなかった 話し 話さ 話しながら",
    "待つ": "待 待って 待った 待たない 待ちます 待てば 待とう 待たず 待ちたい 待ったら 待ったり 待て 待たなかった 待ち 待た 待ちながら",
    "死ぬ": "死 死んで 死んだ 死なない 死にます 死ねば 死のう 死なず 死にたい 死んだら 死んだり 死ね 死ななかった 死に 死な 死にながら",
    "遊ぶ": "遊 遊んで 遊んだ 遊ばない 遊びます 遊べば 遊ぼう 遊ばず 遊びたい 遊んだら 遊んだり 遊べ 遊ばなかった 遊び 遊ば 遊びながら",
    "飲む": "飲 飲んで 飲んだ 飲まない 飲みます 飲めば 飲もう 飲まず 飲みたい 飲んだら 飲んだり 飲め 飲まなかった 飲み 飲ま 飲みながら",
    "買う": "買 買って 買った 買わない 買います 買えば 買おう 買わず 買いたい 買ったら 買ったり 買え 買わなかった 買い 買わ 買いながら",
    "高い": "高く 高くて 高かった 高くない 高くなかった 高ければ 高さ 高そう 高すぎる 高すぎ 高み 高",
    "静かな": "静か 静かに 静かだ 静かで 静かだった 静かではない 静かじゃない",
}
INTERIM_FORMS = {
    "食べる": "食べ 食べて 食べた 食べない 食べます 食べれば 食べよう 食べられる 食べさせる 食べている 食べていた 食べてる 食べてた "
              "食べず 食べずに 食べたい 食べたら 食べたり 食べろ 食べれ 食べさせ 食べられ 食べなかった 食べません",
    "書く": "書か 書き 書いて 書いた 書かない 書きます 書けば 書こう 書かず 書きたい 書いたら 書いたり 書け 書かなかった 書",
}
FIRST_FORMS = {
    "食べる": "食べ 食べて 食べた 食べない 食べます 食べれば 食べよう 食べられる 食べさせる 食べている 食べていた 食べてる 食べてた "
              "食べず 食べずに 食べたい 食べたら 食べたり 食べろ 食べれ 食べさせ 食べられ 食べなかった",
    "買う": "買わ 買い 買って 買った 買わない 買います 買えば 買おう 買わず 買いたい 買ったら 買ったり 買え 買わなかった 買",
}


@pytest.mark.parametrize("variant, expected", [(CURRENT, CURRENT_FORMS), (INTERIM, INTERIM_FORMS), (FIRST, FIRST_FORMS)])
def test_forms_of_each_ending(spark, variant, expected):
    words = spark.createDataFrame([(w,) for w in expected], "w string")
    found = words.select("w", candidate_forms(F.col("w"), variant)["form"].alias("forms")).collect()
    # the word itself stands in front, and the rules may give it once more
    assert {r["w"]: [f for f in r["forms"] if f != r["w"]] for r in found} == {w: f.split() for w, f in expected.items()}


def test_the_ending_is_shown_in_the_current_release_only(spark):
    word = spark.createDataFrame([("書く",)], "w string")
    for variant, shown in ((CURRENT, "～いて"), (INTERIM, ""), (FIRST, "")):
        (row,) = word.select(candidate_forms(F.col("w"), variant).alias("c")).collect()
        assert {c["display"] for c in row["c"] if c["form"] == "書いて"} == {shown}
