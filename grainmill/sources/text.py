"""Reading corpora: files to texts, texts to lines, paragraphs, pairs and typed blocks.

Parsers work on a table (path, text) with one row for each file and stay inside that row: the lines of a file are an
array until they are exploded, so a file needs no shuffle and no window however many files there are. Line ends of all
kinds (\\r\\n, \\r, \\n) count as one. Null texts have no lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmill.functions.text import printable_runs, strip


def read_corpus(spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, text): one row for each file."""
    opts = {"wholetext": True} | ({"pathGlobFilter": glob} if glob else {}) | ({"recursiveFileLookup": True} if recursive else {})
    return spark.read.text(path, **opts).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def line_array(text: Column | str = "text") -> Column:
    """The lines of a text; a line break at the very end starts no further line."""
    t = F.regexp_replace(F.col(text) if isinstance(text, str) else text, "\r\n?", "\n")
    t = F.regexp_replace(t, "\n\\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "\n"))


def lines(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, line_no from 1, line)."""
    return texts.select(key, F.posexplode(line_array(text)).alias("_p", "line")).select(key, (F.col("_p") + 1).alias("line_no"), "line")


def answer_lines(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, line_no, a): lines that begin with "A: " once white space is stripped."""
    s = strip("line")
    return lines(texts, key, text).where(s.startswith("A: ")).select(key, "line_no", strip(F.substring(s, 4, 1 << 30)).alias("a"))


def prose_lines(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, line_no, line): stripped, not blank and neither question nor answer; "Do:" lines count as prose."""
    s = strip("line")
    return lines(texts, key, text).where((s != "") & ~s.startswith("Q: ") & ~s.startswith("A: ")).select(key, "line_no", s.alias("line"))


def paragraphs(texts: DataFrame, key: str = "path", text: str = "text", runs: bool = False) -> DataFrame:
    """(key, par_no from 1, text): split at "\\n\\n" exactly (or at longer runs as well), stripped, blank ones dropped."""
    t = F.regexp_replace(F.col(text), "\r\n?", "\n")
    parts = F.filter(F.transform(F.split(t, "\n\n+" if runs else "\n\n"), strip), lambda p: p != "")
    return texts.select(key, F.posexplode(parts).alias("_p", "text")).select(key, (F.col("_p") + 1).alias("par_no"), "text")


def two_line_blocks(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, par_no, type, q, a, text): paragraphs whose first two lines are question and response, else prose.

    Further lines of such a paragraph are left out, which is the known loss of this mode.
    """
    p = paragraphs(texts, key, text, runs=True)
    ls = F.split("text", "\n")
    l1, l2 = F.get(ls, F.lit(0)), F.coalesce(F.get(ls, F.lit(1)), F.lit(""))
    kind = F.when(l1.startswith("Q: ") & l2.startswith("A: "), "A").when(l1.startswith("Q: ") & l2.startswith("Do: "), "Do")
    p = p.withColumn("prefix", kind)
    return p.select(
        key,
        "par_no",
        F.when(F.col("prefix").isNotNull(), "qa").otherwise("prose").alias("type"),
        F.when(F.col("prefix").isNotNull(), strip(F.substring(l1, 4, 1 << 30))).alias("q"),
        F.when(F.col("prefix") == "A", strip(F.substring(l2, 4, 1 << 30))).when(F.col("prefix") == "Do", strip(F.substring(l2, 5, 1 << 30))).alias("a"),
        "prefix",
        F.when(F.col("prefix").isNull(), F.col("text")).alias("text"),
    )


def _marked(text: str) -> Column:
    """Marker lines of a text: array of (line_no, mark, body)."""
    ls = F.transform(line_array(text), lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("line")))
    mark = lambda x: F.when(x.startswith("Q: "), "Q").when(x.startswith("A: "), "A").when(x.startswith("Do: "), "Do")
    ms = F.transform(ls, lambda s: F.struct(s["line_no"].alias("line_no"), mark(s["line"]).alias("mark"), strip(F.regexp_replace(s["line"], "^(?:Q|A|Do): ", "")).alias("body")))
    return F.filter(ms, lambda s: s["mark"].isNotNull())


def line_pairs(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, line_no, q, a, prefix): the pending-question reading.

    Only marker lines count. A question with a response as the next marker is a pair, across prose or blank lines; a
    question before another question or the end has an empty response, a response without question an empty question.
    """
    m = texts.select(key, _marked(text).alias("_m"))
    near = F.transform(
        "_m",
        lambda s, i: F.struct(
            s.alias("s"),
            F.get(F.col("_m"), i + 1).alias("next"),
            F.when(i > 0, F.get(F.col("_m"), i - 1)["mark"]).alias("prev"),
        ),
    )
    e = m.select(key, F.explode(near).alias("x")).select(key, "x.s.line_no", "x.s.mark", "x.s.body", "x.next", "x.prev")
    is_q = F.col("mark") == "Q"
    answered = is_q & F.coalesce(F.col("next.mark") != "Q", F.lit(False))
    orphan_a = ~is_q & F.coalesce(F.col("prev") != "Q", F.lit(True))
    return e.where(is_q | orphan_a).select(
        key,
        "line_no",
        F.when(is_q, F.col("body")).otherwise("").alias("q"),
        F.when(answered, F.col("next.body")).when(is_q, "").otherwise(F.col("body")).alias("a"),
        F.when(answered, F.col("next.mark")).when(is_q, F.lit(None)).otherwise(F.col("mark")).alias("prefix"),
    )


def adjacent_pairs(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, line_no, q, a): a stripped "Q: " line whose very next line is an "A: " line."""
    ls = F.transform(line_array(text), strip)
    near = texts.select(key, ls.alias("_l")).select(
        key, F.explode(F.transform("_l", lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("x"), F.get(F.col("_l"), i + 1).alias("y")))).alias("s")
    )
    return near.where(F.col("s.x").startswith("Q: ") & F.col("s.y").startswith("A: ")).select(
        key, "s.line_no", strip(F.substring("s.x", 4, 1 << 30)).alias("q"), strip(F.substring("s.y", 4, 1 << 30)).alias("a")
    )


def blocks(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, block_no, line_no, type, q, a, do, text, next_line): the line look-ahead reading.

    A question pairs only with the very next line; otherwise it is an orphan that keeps that line. Responses no
    question took are orphans. Other text begins a run of prose up to a blank or question line, so a response line
    right after prose belongs to the prose. A row's line is its first.
    """
    kind = lambda x: F.when(x.startswith("Q: "), "1").when(x.startswith("A: "), "2").when(x.startswith("Do: "), "3").when(strip(x) == "", "0").otherwise("4")
    base = texts.select(key, line_array(text).alias("_l")).withColumn("_k", F.array_join(F.transform("_l", kind), ""))
    # one letter for each line: 0 blank, 1 question, 2 and 3 free responses, 4 first line of prose, 5 more of it, 6 response of the line before
    taken = F.regexp_replace("_k", "(?<=1)[23]", "6")
    base = base.select(key, "_l", F.regexp_replace(taken, r"(?:(?<=4)|\G(?!^))[234]", "5").alias("_r"))

    def seen(x: Column, i: Column) -> Column:
        role = F.substring(F.col("_r"), i + 1, F.lit(1))
        more = F.when(role == "4", F.length(F.regexp_extract(F.substring(F.col("_r"), i + 2, F.length("_r")), "^5*", 0))).otherwise(0)
        return F.struct(
            (i + 1).alias("line_no"),
            role.alias("role"),
            (F.substring(F.col("_r"), i + 2, F.lit(1)) == "6").alias("taken"),
            F.when(role == "1", F.get(F.col("_l"), i + 1)).alias("next"),
            F.when(role == "4", F.array_join(F.transform(F.slice(F.col("_l"), i + 1, more + 1), strip), " ")).otherwise(x).alias("x"),
        )

    kept = F.filter(F.transform("_l", seen), lambda s: s["role"].isin("1", "2", "3", "4"))
    e = base.select(key, F.posexplode(kept).alias("_p", "s")).select(key, (F.col("_p") + 1).alias("block_no"), "s.*")
    r, nxt = F.col("role"), F.col("next")
    typ = (
        F.when((r == "1") & F.col("taken"), F.when(nxt.startswith("A: "), "qa").otherwise("do"))
        .when(r == "1", "orphan_q")
        .when(r == "2", "orphan_a")
        .when(r == "3", "orphan_do")
        .otherwise("prose")
    )
    cut = lambda c, n: strip(F.substring(c, n, 1 << 30))
    t = F.col("type")
    return e.withColumn("type", typ).select(
        key,
        "block_no",
        "line_no",
        "type",
        F.when(t.isin("qa", "do", "orphan_q"), cut("x", 4)).alias("q"),
        F.when(t == "qa", cut("next", 4)).when(t == "orphan_a", cut("x", 4)).alias("a"),
        F.when(t == "do", cut("next", 5)).when(t == "orphan_do", cut("x", 5)).alias("do"),
        F.when(t == "prose", F.col("x")).alias("text"),
        F.when(t == "orphan_q", F.coalesce("next", F.lit(""))).alias("next_line"),
    )


def word_list(texts: DataFrame, key: str = "path", text: str = "text", keep_case: bool = False) -> DataFrame:
    """(ord, word): entries of a list with one entry for each line; blank lines and # comments skipped."""
    w = strip("line") if keep_case else F.lower(strip("line"))
    ls = lines(texts, key, text).withColumn("word", w).where((F.col("word") != "") & ~F.col("word").startswith("#"))
    return ls.groupBy("word").agg(F.min("line_no").alias("ord")).select("ord", "word")


def forced_words(texts: DataFrame, key: str = "path", text: str = "text", min_len: int = 3) -> DataFrame:
    """(word): the a-z0-9 words of all entries of a word list that are long enough and not all digits."""
    w = word_list(texts, key, text).select(F.explode(F.regexp_extract_all("word", F.lit("([a-z0-9]+)"), F.lit(1))).alias("word"))
    return w.where((F.length("word") >= min_len) & ~F.col("word").rlike("^[0-9]+$")).distinct()


def source_commands(texts: DataFrame, text: str = "text", shortest: int = 2, longest: int = 40) -> DataFrame:
    """(command): names that source code registers, as a call registerCommand("name") or a table entry {"name"."""
    found = F.concat(
        F.regexp_extract_all(F.col(text), F.lit(r'\{\s*"([a-z][a-z0-9_ ]+)"'), F.lit(1)),
        F.regexp_extract_all(F.col(text), F.lit(r'registerCommand\s*\(\s*"([a-z][a-z0-9_ ]+)"'), F.lit(1)),
    )
    c = texts.select(F.explode(found).alias("command")).select(F.lower(F.trim("command")).alias("command"))
    return c.where(F.length("command").between(shortest, longest)).distinct()


def list_literal(texts: DataFrame, name: str, text: str = "text") -> DataFrame:
    """(ord, entry): the strings of a list assigned to ``name`` in source code."""
    inside = F.regexp_extract(text, rf"(?s)\b{name}\s*=\s*\[(.*?)\]", 1)
    return texts.select(F.posexplode(F.regexp_extract_all(inside, F.lit(r'"([^"]+)"'), F.lit(1))).alias("ord", "entry"))


def test_prompts(texts: DataFrame, key: str = "path", text: str = "text") -> DataFrame:
    """(key, line_no, prompt): question lines with an answer mark to go on from."""
    s = strip("line")
    return lines(texts, key, text).where(s.startswith("Q:")).select(key, "line_no", F.concat(s, F.lit("\nA:")).alias("prompt"))


def binary_strings(spark: SparkSession, path: str, min_len: int = 3) -> DataFrame:
    """(path, ord, run): runs of at least so many printable ASCII bytes of binary files."""
    raw = spark.read.format("binaryFile").load(path)
    return raw.select("path", F.posexplode(printable_runs("content", min_len)).alias("ord", "run"))


def json_records(spark: SparkSession, path: str, schema: str, key: str, expected: int | None = None) -> DataFrame:
    """A JSON array of records, checked: keys not null and unique, and 1 to ``expected`` if given; else ValueError."""
    df = spark.read.schema(schema).json(path, multiLine=True)
    n, d, lo, hi, nulls = df.agg(F.count(key), F.countDistinct(key), F.min(key), F.max(key), F.count_if(F.col(key).isNull())).first()
    if nulls or n != d or (expected is not None and (n, lo, hi) != (expected, 1, expected)):
        raise ValueError(f"{key} must be unique" + (f" and run from 1 to {expected}" if expected else ""))
    return df


TOKENIZER_SCHEMA = "model struct<vocab: map<string,int>, merges: array<string>>, added_tokens array<struct<id: int, content: string>>"


def tokenizer_vocab(texts: DataFrame, text: str = "text") -> DataFrame:
    """(token, id) of tokenizer JSON texts, added tokens included; an added token wins over the vocabulary."""
    j = texts.select(F.from_json(text, "struct<" + TOKENIZER_SCHEMA.replace("model struct", "model: struct").replace("added_tokens array", "added_tokens: array") + ">").alias("j"))
    base = j.select(F.explode("j.model.vocab").alias("token", "id")).withColumn("_o", F.lit(0))
    more = j.select(F.explode("j.added_tokens").alias("t")).select(F.col("t.content").alias("token"), F.col("t.id").alias("id"), F.lit(1).alias("_o"))
    return base.unionByName(more).groupBy("token").agg(F.max_by("id", "_o").alias("id"))


def tokenizer_merges(texts: DataFrame, text: str = "text") -> DataFrame:
    """(ord, left_id, right_id, new_id) of the merge rules; a rule with a part or result not in the vocabulary is dropped."""
    v = tokenizer_vocab(texts, text)
    j = texts.select(F.from_json(text, "struct<" + TOKENIZER_SCHEMA.replace("model struct", "model: struct").replace("added_tokens array", "added_tokens: array") + ">").alias("j"))
    m = j.select(F.posexplode("j.model.merges").alias("ord", "rule")).where("rule like '% %'")
    m = m.select("ord", F.substring_index("rule", " ", 1).alias("l"), F.expr("substring(rule, instr(rule, ' ') + 1)").alias("r"))
    for part, key in (("left_id", F.col("l")), ("right_id", F.col("r")), ("new_id", F.concat("l", "r"))):
        side = v.select(F.col("token").alias("_t"), F.col("id").alias(part))
        m = m.join(side, key == F.col("_t")).drop("_t")
    return m.select("ord", "left_id", "right_id", "new_id")
