"""Letters of every script count as letters."""

from __future__ import annotations

from tidemark.llm import quality


def test_letters_beyond_the_first_planes():
    latin = quality.statistics("abcd efgh")
    for text in ("한국어의 문장입니", "中文句子 四个字的", "ｆｕｌｌ ｗｉｄｅ", "\U00020000\U00020001\U00020002\U00020003 \U00020000\U00020001\U00020002\U00020004"):
        found = quality.statistics(text)
        assert found[2:5] == latin[2:5]
    assert quality.statistics("\U0001f600")[3] > latin[3] and quality.statistics("\ud800")[3] > latin[3]
