"""Verbatim leaks in any script and with typographic signs, against longest common subsequences over code points; and words by Unicode."""

import random
import re
import unicodedata

import pyarrow as pa
import pytest

from quotemill.llm.decontaminate import find_leaks
from quotemill.llm.textcore import plain_words, spaced

ITEMS = {
    1: "東京は日本の首都であり、世界でも有数の大都市です。人口は約千四百万人で、政治と経済の中心となっています。答えは東京都です。",
    2: "“Don’t look back”—said the old sailor—“the harbour lights won’t show the way, it’s the stars that do”, and nobody spoke until morning.",
    3: "长江是中国最长的河流，全长约六千三百公里，发源于青藏高原，最后注入东海。它流经十一个省级行政区，是重要的水路。",
    4: "كان الطقس في المدينة القديمة حارا جدا في ذلك الصيف، ولم يخرج أحد من البيوت قبل غروب الشمس بساعة كاملة.",
    5: "Die größte Überraschung für die Bürger der Stadt war, dass die „neue Brücke“ über den Fluss schon im Frühjahr geöffnet wurde.",
    6: "กรุงเทพมหานครเป็นเมืองหลวงของประเทศไทยและเป็นศูนย์กลางทางเศรษฐกิจการเมืองและวัฒนธรรมของประเทศ",
}
FILLER = {
    1: "山の上には古い寺があり春になると桜が咲く。",
    2: "A plain line of other words that has nothing in common with them. ",
    3: "今天天气很好我们一起去公园散步看书。",
    4: "هذا نص آخر لا علاقة له بالموضوع السابق أبدا. ",
    5: "Ein anderer Satz ganz ohne Bezug zu dem, was gefragt war. ",
    6: "วันนี้อากาศดีมากเราไปเดินเล่นในสวนกันเถอะ",
}


def plain(text):
    """Quotes and dashes as a keyboard has them, decomposed letters, and no-break blanks."""
    text = text.translate(str.maketrans({"’": "'", "“": '"', "”": '"', "„": '"', "—": " - "}))
    return unicodedata.normalize("NFD", text).replace(" ", " ")


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def letters(text):
    return [c for c in unicodedata.normalize("NFKC", text).lower() if unicodedata.category(c)[0] in "LMN"]


@pytest.mark.parametrize("change", [lambda t: t, plain, lambda t: t.replace("a", "a­").upper()])
def test_leaks_are_found(spark, change):
    rows = [(10 * k, FILLER[k] * 6 + change(item) + FILLER[k] * 6) for k, item in ITEMS.items()]
    rows += [(10 * k + 1, FILLER[k] * 20) for k in ITEMS]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(list(ITEMS.items()), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, items).collect()}
    want = {(d, k) for d, text in rows for k, item in ITEMS.items() if lcs(letters(item), letters(text)) >= 0.95 * len(letters(item))}
    assert want == {(10 * k, k) for k in ITEMS}
    assert found == want


def slow_words(text):
    """Words from their definition."""
    out, run, paired = [], "", False

    def flush():
        nonlocal run
        if run:
            out.extend([run] if not paired or len(run) == 1 else [run[i : i + 2] for i in range(len(run) - 1)])
        run = ""

    for c in unicodedata.normalize("NFKC", text).lower():
        kind = unicodedata.category(c)
        if kind == "Cf":
            continue
        if kind[0] not in "LMN":
            flush()
            continue
        two = bool(re.match("[฀-࿿က-႟ក-៿々-〇぀-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003347f]", c))
        if two != paired:
            flush()
        paired, run = two, run + c
    flush()
    return out


def test_words_by_category():
    rng = random.Random(4)
    signs = "aZ9 .,'’“— ­‍\n\té́ßΣ東京カナ・ー一กำ๑한국어ع١\U00020000😀_#\x00\x1f\x7f\x85"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(300)] + ["", "plain words only", "東", "東京x", *ITEMS.values()]
    hashes, counts = plain_words(pa.array(texts))
    want = [slow_words(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert [w for t in texts for w in spaced(t).split()] == [w for ws in want for w in ws]
    known, flat = {}, [w for ws in want for w in ws]
    assert all(known.setdefault(w, h) == h for w, h in zip(flat, hashes.tolist()))
    assert len(set(known.values())) == len(known)
    # a word has one hash, in texts of ASCII alone and in others
    assert plain_words(pa.array(["a word", "é a word"]))[0].tolist()[:2] == plain_words(pa.array(["é a word"]))[0].tolist()[1:]
