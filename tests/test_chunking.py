from conceptloom.operators.chunking import chunk_documents, cut_text, primary_section, section_chunks


def test_cut_text_ends_at_boundaries_and_never_cuts_words():
    text = "One sentence here. " * 60
    parts = cut_text(text, 200, 40, 30)
    assert all(len(p) <= 200 for p in parts) and {w for p in parts for w in p.split()} == {"One", "sentence", "here."}
    assert cut_text("x" * 500, 100) == ["x" * 500]
    assert cut_text("", 10) == [] and cut_text("abc", 10) == ["abc"]


def test_sections_are_hard_boundaries():
    pages = [(1, "1.1 First\n\n" + "Alpha beta. " * 30), (2, "1.2 Second\n\nGamma.")]
    got = section_chunks(pages, {"1.1", "1.2"}, 200, 50, 20)
    assert [c["section"] for c in got][-1] == "1.2" and got[-1]["text"].startswith("1.2 Second")
    assert "Alpha" not in got[-1]["text"] and got[-1]["pages"] == [2]
    assert all(c["section"] == "1.1" for c in got[:-1])


def test_chunk_documents_handles_nulls(spark):
    pages = spark.createDataFrame([("d", 1, None), ("e", 1, "Text.")], "doc string, page int, text string")
    assert [(r["doc"], r["chunk_id"], r["text"]) for r in chunk_documents(pages, []).collect()] == [("e", "c0001", "Text.")]


def test_repeated_text_gives_way_to_new_text():
    one = "Alpha beta gamma delta. " * 82
    got = section_chunks([(1, one.strip() + "\n\n" + one.replace("Alpha", "Omega").strip())], set(), 2000, 300, 500)
    assert len(got) == 2 and all(len(c["text"]) <= 2000 for c in got)
    short = section_chunks([(1, "A word. " * 240 + "\n\nThe end.")], set(), 2000, 300, 500)
    assert all(len(c["text"]) <= 2000 for c in short) and short[-1]["text"].endswith("The end.")


def test_primary_section_by_heading_then_by_pages():
    text = "3.1\nProcess\n\n" + "x " * 10 + "\n\n3.2 Threads\n" + "y " * 50
    assert primary_section(text, [4], ["3.1", "3.2"], {}) == "3.2"
    assert primary_section("no heading", [4, 5, 6], ["3.2", "3.10"], {4: ["3.2"], 5: ["3.2", "3.10"], 6: ["3.10"]}) == "3.10"
    assert primary_section("no heading", [4], [], {}) == ""
