import pytest

from conceptloom.llm.sentences import sentence_spans, split_sentences

CASES = {
    "Dr. Low met J. K. Moor at 4 p.m. on Jan. 3. It cost $4.50, i.e. little! Was it v2.6.32?": ["Dr. Low met J. K. Moor at 4 p.m. on Jan. 3.", "It cost $4.50, i.e. little!", "Was it v2.6.32?"],
    "The shift ends at 6 p.m. Any page is free, etc. Next one.": ["The shift ends at 6 p.m.", "Any page is free, etc.", "Next one."],
    "“Never hold two. Release one,” it warns, “and only then wait.” Next.": ["“Never hold two. Release one,” it warns, “and only then wait.”", "Next."],
    "The guide asks: “Who owns it?” (This is new. And old.) A pool (a lazy one. It is rare.) waits.": ["The guide asks: “Who owns it?”", "(This is new.", "And old.)", "A pool (a lazy one. It is rare.) waits."],
    "It stops at ... and stays. It ends... So be it.": ["It stops at ... and stays.", "It ends...", "So be it."],
    "Ein Faden wartet, d. h. er ruht. „Halt!“ ruft er. Dr. Low maß am 3. Mai genau 2 Fehler.": ["Ein Faden wartet, d. h. er ruht.", "„Halt!“ ruft er.", "Dr. Low maß am 3. Mai genau 2 Fehler."],
    "Le guide dit : « Verrouillez. Puis écrivez. » « Arrêtez ! » affiche le noyau. Qui attend ?": ["Le guide dit : « Verrouillez. Puis écrivez. »", "« Arrêtez ! » affiche le noyau.", "Qui attend ?"],
    "手冊寫道：「先取得鎖。再進入臨界區。」請參考第 3.8 節。他問：「誰？」然後離開了。「停！」是訊息……好。": ["手冊寫道：「先取得鎖。再進入臨界區。」", "請參考第 3.8 節。", "他問：「誰？」然後離開了。", "「停！」是訊息……", "好。"],
    "手引きには「先に取る。次に入る。」と書かれている。平均は約 1.75 倍（表 9.5 参照。）である。": ["手引きには「先に取る。次に入る。」と書かれている。", "平均は約 1.75 倍（表 9.5 参照。）である。"],
    "क्या ताला है? “रुको!” कहकर बंद हो जाता है। डॉ. Low ने बताई।": ["क्या ताला है?", "“रुको!” कहकर बंद हो जाता है।", "डॉ. Low ने बताई।"],
    "هل يملك القفل؟ لا تحرر!": ["هل يملك القفل؟", "لا تحرر!"],
    "ตัวจัดตารางงานย้าย คำสั่ง fork() สร้าง เวลา 1.5 วินาที": ["ตัวจัดตารางงานย้าย", "คำสั่ง fork() สร้าง", "เวลา 1.5 วินาที"],
    "На рис. 1 показан, т. е. весь. «Стоп!» — пишет ядро. В 1997 г. всё.": ["На рис. 1 показан, т. е. весь.", "«Стоп!» — пишет ядро.", "В 1997 г. всё."],
    "4.1 Heading\n \nWrapped at\nthe line. Done.\n\nIt has these parts:\n• one;\n• two items. \n\n": ["4.1 Heading", "Wrapped at\nthe line.", "Done.", "It has these parts:", "• one;", "• two items."],
    "﻿  First.\xa0Second. \t": ["First.", "Second."],
    "The drive letter is d. Then it mounts.": ["The drive letter is d.", "Then it mounts."],
    "The unit is h. The clock ticks.": ["The unit is h.", "The clock ticks."],
    "Press z. Then press Enter.": ["Press z.", "Then press Enter."],
    "The answer is ca. The rest is noise.": ["The answer is ca.", "The rest is noise."],
    "He told me. Then he left.": ["He told me.", "Then he left."],
    "Das Verfahren ist ca. 30 Jahre alt, d. h. es ist reif.": ["Das Verfahren ist ca. 30 Jahre alt, d. h. es ist reif."],
    "Он живёт в г. Москва. Это было в 1997 г. Москва была другой.": ["Он живёт в г. Москва.", "Это было в 1997 г.", "Москва была другой."],
    "Τι είναι αυτό; Είναι ο πυρήνας. Ποιος περιμένει\u037e Κανείς.": ["Τι είναι αυτό;", "Είναι ο πυρήνας.", "Ποιος περιμένει\u037e", "Κανείς."],
    "It waits.\u200f Then it runs. ﻿Stop!\u0301 Go.": ["It waits.\u200f", "Then it runs.", "Stop!\u0301", "Go."],
    "In German: the kernel is here.\n\nDer Kern ist z. B. hier und die Zahl ist h. Das ist ein Rest.": ["In German: the kernel is here.", "Der Kern ist z. B. hier und die Zahl ist h. Das ist ein Rest."],
    "": [],
    " \r\n\t\n": [],
}


@pytest.mark.parametrize("text", CASES)
def test_units(text):
    assert [text[a:b] for a, b in sentence_spans(text)] == CASES[text]


def test_units_never_overlap_and_leave_only_white_space():
    text = "A (b. “C! d” e.) f.\n\n(unclosed. “Quote. Next one. " * 50
    spans = sentence_spans(text)
    assert all(a < b for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    covered = bytearray(len(text))
    for a, b in spans:
        covered[a:b] = b"1" * (b - a)
    assert all(c or t.isspace() for c, t in zip(covered, text))


def test_split_handles_nulls_repeats_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "One. Two.", 5), (1, "One. Two.", 5), (2, None, 5), (3, "", 5), (4, "x " * 60_000, 5)], "doc_id long, text string, sent_start int")
    rows = [tuple(r) for r in split_sentences(docs, with_text=True).collect()]
    assert sorted(rows)[:4] == [(1, 0, 4, "One."), (1, 0, 4, "One."), (1, 5, 9, "Two."), (1, 5, 9, "Two.")]
    assert [r[0] for r in rows].count(4) == 1 and split_sentences(docs.limit(0)).count() == 0
