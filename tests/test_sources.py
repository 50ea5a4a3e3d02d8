import random

from grainmill.sources import text as src
from pyspark.sql import functions as F


def plain_blocks(t):
    ls = t.replace("\r\n", "\n").replace("\r", "\n")
    ls = ls[:-1] if ls.endswith("\n") else ls
    ls = ls.split("\n") if ls else []
    out, i = [], 0
    while i < len(ls):
        x = ls[i]
        n = ls[i + 1] if i + 1 < len(ls) else ""
        if x.startswith("Q: ") and n.startswith(("A: ", "Do: ")):
            a = n.startswith("A: ")
            out.append((i + 1, "qa" if a else "do", x[3:].strip(), n[3:].strip() if a else None, None if a else n[4:].strip(), None, None))
            i += 2
        elif x.startswith("Q: "):
            out.append((i + 1, "orphan_q", x[3:].strip(), None, None, None, n))
            i += 1
        elif x.startswith("A: "):
            out.append((i + 1, "orphan_a", None, x[3:].strip(), None, None, None))
            i += 1
        elif x.startswith("Do: "):
            out.append((i + 1, "orphan_do", None, None, x[4:].strip(), None, None))
            i += 1
        elif not x.strip():
            i += 1
        else:
            s, run = i, []
            while i < len(ls) and ls[i].strip() and not ls[i].startswith("Q: "):
                run.append(ls[i].strip())
                i += 1
            out.append((s + 1, "prose", None, None, None, " ".join(run), None))
    return out


def plain_pairs(t):
    out, wait = [], None
    for n, x in enumerate(t.split("\n"), 1):
        if x.startswith("Q: "):
            if wait:
                out.append((*wait, "", None))
            wait = (n, x[3:].strip())
        elif x.startswith(("A: ", "Do: ")):
            mark, body = x.split(": ", 1)
            out.append((*wait, body.strip(), mark) if wait else (n, "", body.strip(), mark))
            wait = None
    return sorted(out + ([(*wait, "", None)] if wait else []))


def texts(spark):
    r = random.Random(3)
    pick = ["Q: q%d", "A: a%d", "Do: d%d", "", "  ", "prose %d", " A: in %d"]
    return [(str(i), "\n".join((s % j if "%" in (s := r.choice(pick)) else s) for j in range(r.randrange(14)))) for i in range(200)]


def test_parsers_equal_plain_readings(spark):
    docs = texts(spark)
    df = spark.createDataFrame(docs, "path string, text string")
    got, pairs = {}, {}
    for x in src.blocks(df).orderBy("path", "line_no").collect():
        got.setdefault(x.path, []).append((x.line_no, x.type, x.q, x.a, x.do, x.text, x.next_line))
    for x in src.line_pairs(df).collect():
        pairs.setdefault(x.path, []).append((x.line_no, x.q, x.a, x.prefix))
    for p, t in docs:
        assert got.get(p, []) == plain_blocks(t)
        assert sorted(pairs.get(p, []), key=lambda x: x[0]) == plain_pairs(t)


def test_block_numbers_null_and_empty(spark):
    df = spark.createDataFrame([("a", "Q: x\r\nA: y\r\n\r\nword\n"), ("b", None), ("c", ""), ("d", "\n")], "path string, text string")
    rows = [(x.path, x.block_no, x.type) for x in src.blocks(df).orderBy("path", "block_no").collect()]
    assert rows == [("a", 1, "qa"), ("a", 2, "prose")]
    assert src.lines(df).where("path = 'b'").count() == 0


def test_two_readings_differ_on_several_turns(spark):
    df = spark.createDataFrame([("p", "Q: a\nA: b\nQ: c\nA: d\n\n\nQ: e\nDo: f")], "path string, text string")
    assert [(x.q, x.a, x.prefix) for x in src.two_line_blocks(df).orderBy("par_no").collect()] == [("a", "b", "A"), ("e", "f", "Do")]
    assert src.line_pairs(df).count() == 3
    assert src.paragraphs(df).count() == 2


def test_only_commands_and_prose(spark):
    df = spark.createDataFrame([("p", "Do: x\nword\nA: taken by prose\n\n A: indented")], "path string, text string")
    assert [x.type for x in src.blocks(df).orderBy("block_no").collect()] == ["orphan_do", "prose", "prose"]
    assert [x.a for x in src.answer_lines(df).orderBy("line_no").collect()] == ["taken by prose", "indented"]
    assert src.prose_lines(df).count() == 2


def test_binary_strings_and_json(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"\x00ab\x01abc\x02abcd\xff")
    assert [x.run for x in src.binary_strings(spark, str(tmp_path / "x.bin")).orderBy("ord").collect()] == ["abc", "abcd"]
    (tmp_path / "e.json").write_text('[{"n": 1, "s": "a"}, {"n": 2, "s": "b"}]')
    assert src.json_records(spark, str(tmp_path / "e.json"), "n int, s string", "n", 2).count() == 2
    (tmp_path / "f.json").write_text('[{"n": 1}, {"n": 1}]')
    try:
        src.json_records(spark, str(tmp_path / "f.json"), "n int", "n")
        raise AssertionError("a repeated key must be refused")
    except ValueError:
        pass


def test_read_corpus_and_code(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.cpp").write_text('registerCommand("go", 1);')
    (tmp_path / "b.txt").write_text("Q: x\nA: y")
    assert [x.command for x in src.source_commands(src.read_corpus(spark, str(tmp_path), "*.cpp", True)).collect()] == ["go"]
    assert src.read_corpus(spark, str(tmp_path), "*.txt").select("text").first()[0] == "Q: x\nA: y"


def test_list_sources_skip_comments(spark):
    df = spark.createDataFrame([("f", "# c\nLamp\n\nlamp\nab 12")], "path string, text string")
    assert {x.word for x in src.word_list(df).collect()} == {"lamp", "ab 12"}
    assert {x.word for x in src.word_list(df, keep_case=True).collect()} == {"Lamp", "lamp", "ab 12"}
    assert {x.word for x in src.forced_words(df).collect()} == {"lamp"}


def test_tokenizer_file_with_missing_merge_result(spark):
    t = '{"model": {"vocab": {"a": 0, "b": 1, "ab": 2}, "merges": ["a b", "b a"]}, "added_tokens": []}'
    df = spark.createDataFrame([(t,)], "text string")
    assert [tuple(x) for x in src.tokenizer_merges(df).collect()] == [(0, 0, 1, 2)]
    assert src.tokenizer_vocab(df).agg(F.count("*")).first()[0] == 3
