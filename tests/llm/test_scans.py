import random

from conceptloom.llm import lexicon, scans
from conceptloom.llm.lexicon import Trie, glyph_edits

TITLES = ["Virtual Memory", "The Paged Machine"]
BODY = "The kernel updates the oldest buffer whenever the scheduler needs another thread. "


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_finds_all_words_within_the_distance():
    rng = random.Random(1)
    words = {"".join(rng.choices("abc", k=rng.randrange(1, 7))) for _ in range(300)}
    trie = Trie(words)
    for word in list(words)[:40] + ["", "abcabcab"]:
        for d in (1, 2):
            assert set(trie.within(word, d)) == {w for w in words if distance(word, w) <= d}


def test_glyph_edits():
    assert glyph_edits("rnoved", "moved") == 1 and glyph_edits("threäd", "thread") == 1 and glyph_edits("cbannc1", "channel", 3) == 3
    assert glyph_edits("pinne", "pinned") is None and glyph_edits("writer", "writes") is None


def frames(spark, sections, chunks=()):
    a = spark.createDataFrame(sections, "chunk_id string, text string, pages array<int>, page_start int, page_end int, page_offsets array<int>")
    b = spark.createDataFrame(list(chunks), "chunk_id string, text string, pages array<int>, page_start int, page_end int")
    return a, b


def test_noise_is_found_and_traps_are_not(spark):
    clean = [(f"k{i}", BODY * 3, [i], i, i, [0]) for i in range(40)]
    noisy = [
        ("head", "Virtual Mem0ry | The Paged Machine\n" + BODY, [7], 7, 7, [0]),
        ("both", "The Paged Machine — Sec. 3.1 — 8\n" + BODY, [8], 8, 8, [0]),
        ("spaced", "V I R T U A L   M E M O R Y\n" + BODY, None, 9, 8, [0]),
        ("number", BODY + "\n—2l—", [21], 21, 21, [0]),
        ("roman", BODY + "\n~ xiv ~", [14], 14, 14, [0]),
        ("word", BODY + "The sche-\nduler waits.", [3], 3, 3, [0]),
        ("ocr", BODY + "The kemel and the tbread wait.", [3], 3, 3, [0]),
        ("notice", "Proof copy, uncorrected\n" + BODY, [3], 3, 3, [0]),
        ("trap", "2.1 Virtual Memory\n\n" + BODY + "It is read-\nOnly now.\n\n4096\n8192\n\n| kemel | 3 |\n\nIN PRACTICE\n\nThe U.S. edition omits the kernel", [3], 3, 3, [0]),
        ("null", None, [1], 1, 1, [0]), ("empty", "", [1], 1, 1, [0]), ("head", "Virtual Mem0ry | The Paged Machine\n" + BODY, [7], 7, 7, [0]),
    ]
    a, b = frames(spark, clean + noisy, [("c1", "p. 5\n" + BODY, [5], 5, 5)])
    got = {tuple(r) for r in scans.find_noise(a, b, TITLES).collect()}
    s = "section_chunks"
    assert got == {
        (s, "head", "header"), (s, "both", "header"), (s, "both", "page_number"), (s, "spaced", "header"), (s, "number", "page_number"), (s, "roman", "page_number"),
        (s, "word", "hyphen"), (s, "ocr", "ocr"), (s, "notice", "header"), ("chunks", "c1", "page_number"),
    }


def test_texts_are_repaired(spark):
    text = "Virtual Memory    7\nThe kemel updates the old-\nest buffer whenever the sche-\n7\nThe Paged Machine | Virtual Memory\nduler needs\nanother tbread.\n\nif (x) { y(); }\n8"
    cut = text.index("The Paged")
    a, b = frames(spark, [(f"k{i}", BODY * 3, [i], i, i, [0]) for i in range(40)] + [("n", text, [7, 8], 7, 8, [0, cut])])
    got = {r["chunk_id"]: r["text"] for r in scans.clean_texts(a, b, TITLES).collect()}
    assert got["n"] == "The kernel updates the oldest buffer whenever the scheduler needs another thread.\n\nif (x) { y(); }"
    assert got["k1"] == (BODY * 3).strip()


def test_empty_tables(spark):
    a, b = frames(spark, [])
    assert scans.find_noise(a, b, TITLES).count() == 0 and scans.clean_texts(a, b, TITLES).count() == 0


def test_a_known_word_with_a_sign_is_no_misreading_in_any_shard(spark):
    counts = spark.createDataFrame([("too", 50), ("tool", 900), ("too!", 5), ("poo!", 5), ("pool", 900)], "word string, n long")
    for shard in (1, 100):
        assert {(r["word"], r["candidate"]) for r in scans.corrections(counts, shard_words=shard).collect()} == {("poo!", "pool")}


def kinds(spark, sections, titles=TITLES, **options):
    a, b = frames(spark, sections)
    return {(r["chunk_id"], r["noise"]) for r in scans.find_noise(a, b, titles, **options).collect()}


CLEAN = [(f"k{i}", BODY * 3, [i], i, i, [0]) for i in range(40)]


def test_page_bounds_far_apart(spark):
    many = [("near", BODY + "\n900", None, 1, 900, [0]), ("far", BODY + "\n1500", None, 1500, 1, [0]), ("out", BODY + "\n1501", None, 1, 1500, [0])]
    assert kinds(spark, CLEAN + many) == {("near", "page_number"), ("far", "page_number")}


def test_words_between_signs_of_unspaced_scripts(spark):
    many = [("plain", "The kemel waits.", [1], 1, 1, [0]), ("mixed", "核心kemel核心 waits.", [1], 1, 1, [0]), ("stop", "它叫kemel。「tbread」", [1], 1, 1, [0]), ("fine", "核心kernel核心", [1], 1, 1, [0])]
    assert kinds(spark, CLEAN + many) == {("plain", "ocr"), ("mixed", "ocr"), ("stop", "ocr")}


def test_accented_and_very_long_words(spark):
    long_word = "donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamtengesellschaft"
    clean = [(f"a{i}", f"Le système attend, {long_word}.", [i], i, i, [0]) for i in range(40)]
    many = [("accent", "Le systèrne attend.", [1], 1, 1, [0]), ("long", long_word.replace("m", "rn", 1), [1], 1, 1, [0])]
    assert kinds(spark, clean + many) == {("accent", "ocr"), ("long", "ocr")}


def test_headers_longer_than_a_line_and_repeated_notices(spark):
    title = "On the many ways in which virtual memory came to be understood, misunderstood and built into the machines of the age"
    many = [("long", f"{title} — {title} | 7\n" + BODY, [7], 7, 7, [0])]
    notices = [(f"n{i}", "Second printing, Tainan Press\n" + BODY + f"\n\nIN PRACTICE\n\n{BODY}", [i], i, i, [0]) for i in range(30)]
    got = kinds(spark, CLEAN + many + notices, TITLES + [title])
    assert got == {("long", "header"), ("long", "page_number")} | {(f"n{i}", "header") for i in range(30)}
    a, b = frames(spark, CLEAN + notices)
    assert "Tainan" not in {r["chunk_id"]: r["text"] for r in scans.clean_texts(a, b, TITLES).collect()}["n3"]


def test_the_words_that_travel_do_not_change_the_result(spark):
    many = [
        ("compound", "It is a page-\ntable. ", [1], 1, 1, [0]), ("whole", "Every page-table and pagetable.", [1], 1, 1, [0]), ("capital", "The Super-\nVisor waits.", [1], 1, 1, [0]),
        ("visor", "A supervisor.", [1], 1, 1, [0]), ("hyphen", "One user-\nlevel part.", [1], 1, 1, [0]), ("level", "A user-level part.", [1], 1, 1, [0]), ("ocr", "The kemel.", [1], 1, 1, [0]),
    ]
    few, all_ = (kinds(spark, CLEAN + many, known_words=n) for n in (3, 50_000))
    assert few == all_ == {("compound", "hyphen"), ("capital", "hyphen"), ("ocr", "ocr")}


def test_context_keeps_a_word_that_follows_again_and_again(spark):
    texts = [(f"c{i}", "The oldest buffer waits.", [i], i, i, [0]) for i in range(80)] + [(f"d{i}", "A ring bufter waits.", [i], i, i, [0]) for i in range(6)]
    assert kinds(spark, texts) == set()
    assert kinds(spark, texts[:-5]) == {("d0", "ocr")}


def test_a_word_is_sent_to_every_trie_it_can_be_in():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghilmnorstuvw", k=rng.randrange(3, 8))) for _ in range(200)]
    for true in words:
        seen = true
        for t, s in rng.sample(lexicon._READ, 40):
            if t in seen and len(seen) < 12:
                seen = seen.replace(t, s, 1)
                break
        if glyph_edits(seen, true) is not None:
            assert true[:2] in scans.entered(seen)


def test_shards_change_nothing(spark):
    counts = spark.createDataFrame([("kernel", 900), ("kemel", 5), ("channel", 700), ("cbannel", 3), ("modern", 800), ("modem", 30), ("rnodern", 2)], "word string, n long")
    got = [{tuple(r) for r in scans.corrections(counts, shard_words=n, block_words=2).collect()} for n in (1, 100)]
    assert got[0] == got[1] and {(w, c) for w, c, *_ in got[0]} == {("kemel", "kernel"), ("cbannel", "channel"), ("modem", "modern"), ("rnodern", "modern")}
