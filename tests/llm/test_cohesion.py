import random

from conceptloom.llm.cohesion import latest_rows, pieces, split_sections


def check(text, limit=2400, overlap=300):
    out = pieces(text, limit, overlap)
    assert all(0 < b - a <= limit for a, b in out) and out[0][0] == 0
    covered = bytearray(len(text))
    for (a, b), (c, d) in zip(out, out[1:]):
        assert a < c and b < d and b - c <= overlap
    for a, b in out:
        covered[a:b] = b"1" * (b - a)
    assert all(x or t.isspace() for x, t in zip(covered, text))
    return out


def test_pieces_of_all_kinds_of_text():
    rng = random.Random(4)
    words = ["kernel", "page", "鎖", "thread.", "\n\n", "\n", "中文。", "x" * 50]
    for _ in range(20):
        check(" ".join(rng.choices(words, k=1500)))
    check("a" * 9000)
    check("é́" * 4000)
    check("中" * 5000)
    check(" " * 5000)
    assert pieces("short") == [(0, 5)] and pieces("") == [(0, 0)]


def test_cut_lies_where_the_topic_changes():
    one = "The kernel schedules a thread on the ready queue. "
    two = "A disk stores sectors behind the journal index. "
    text = one * 30 + two * 30
    first = pieces(text, 2400, 0)[0]
    assert first == (0, len(one) * 30 - 1)


def test_pages_nulls_and_repeats(spark):
    text = ("Page one sentence. " * 100).strip() + "\n" + ("Page two sentence. " * 100).strip()
    rows = [("a", text, [4, 5], [0, 1900], 4, 5, 1), ("a", text, [4, 5], [0, 1900], 4, 5, 2), ("b", text, None, None, 9, 3, 1), ("c", None, None, None, None, None, 1), ("d", "", [1], [0], 1, 1, 1)]
    df = spark.createDataFrame(rows, "chunk_id string, text string, pages array<int>, page_offsets array<int>, page_start int, page_end int, loaded_at int")
    got = split_sections(latest_rows(df, "chunk_id")).collect()
    a = [r for r in got if r["chunk_id"] == "a"]
    assert [r["piece"] for r in sorted(a, key=lambda r: r["piece"])] == list(range(len(a))) and a[0]["n_pieces"] == len(a)
    assert min(r["page_start"] for r in a) == 4 and max(r["page_end"] for r in a) == 5 and all(r["page_start"] <= r["page_end"] for r in a)
    assert {(r["page_start"], r["page_end"]) for r in got if r["chunk_id"] == "b"} == {(3, 9)}
    assert not [r for r in got if r["chunk_id"] in "cd"] and split_sections(df.limit(0)).count() == 0


def test_uniform_text_is_cut_at_the_last_end_of_the_window():
    text = "The same words stand here again. " * 400
    spans = pieces(text.strip())
    assert min(b - a for a, b in spans[:-1]) > 2_300


def test_valleys_of_long_texts_do_not_depend_on_their_layout():
    from conceptloom.llm.cohesion import valley_depths

    rng = random.Random(3)
    texts = [" ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta iota kappa".split(), k=5)) for _ in range(300)]
    assert abs(valley_depths(texts, span=7) - valley_depths(texts, span=1000)).max() < 1e-5
