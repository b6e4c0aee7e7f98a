import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scripts as S
from ledgerloom.operators import scripts


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    "text,blocks",
    [
        ("select 1", ["select 1"]),
        ("GO", []),
        ("a\nGO\nb", ["a\n", "\nb"]),
        ("a\n  go\t\nb", ["a\n", "\nb"]),
        ("a\r\nGO\r\nb", ["a\r\n", "\nb"]),
        ("GOTO x\nLOGO\nGO x", ["GOTO x\nLOGO\nGO x"]),
        ("a\nGO", ["a\n"]),
        ("GO\nGO\n \nGO\na", ["\na"]),
        ("", []),
        (None, None),
    ],
)
def test_split_blocks(spark, text, blocks):
    assert one(spark, text, S.split_blocks) == blocks


def test_other_delimiter(spark):
    assert one(spark, "a\n\\\nb\nGO", lambda c: S.split_blocks(c, "\\")) == ["a\n", "\nb\nGO"]


def test_strip_comments(spark):
    assert one(spark, "a/* x\nGO\n*/b/**/c /* open", S.strip_comments) == "abc /* open"
    assert one(spark, "a{-x-}b", lambda c: S.strip_comments(c, "{-", "-}")) == "ab"


def lexed(text, start="/*", end="*/", comments=False):
    """Blocks and the text without comments, one character after the other."""
    depth, quote, i, out, opened = 0, "", 0, [], 0
    close = {"'": "'", '"': '"', "[": "]", "--": "\n"}
    while i < len(text):
        two, one = text[i : i + 2], text[i]
        if depth:
            if two in (start, end):
                depth += 1 if two == start else -1
                out += [(c, "comment") for c in two]
                i += 2
                continue
            out.append((one, "comment"))
        elif not quote and two == start:
            depth, opened = 1, len(out)
            out += [(c, "comment") for c in two]
            i += 2
            continue
        elif not quote:
            quote = two if two == "--" else one if one in "'\"[" else ""
            out += [(c, "code") for c in (quote or one)]
            i += len(quote) or 1
            continue
        elif quote == "[" and two == "]]":
            out += [("]", "quoted")] * 2
            i += 2
            continue
        else:
            ends = one == close[quote]
            out.append((one, "code" if ends and quote == "--" else "quoted"))
            quote = "" if ends else quote
        i += 1
    if depth:
        out[opened:] = [(c, "code") for c, _ in out[opened:]]
    kept = [(c, kind) for c, kind in out if comments or kind != "comment"]
    lines, blocks = [[]], [[]]
    for c, kind in kept:
        lines[-1].append((c, kind))
        if c == "\n" and kind == "code":
            lines.append([])
    for line in lines:
        body = "".join(c for c, _ in line)
        bare = body[:-1] if line and line[-1] == ("\n", "code") else body
        if re.fullmatch(r"[ \t]*GO[ \t]*\r?", bare, re.I):
            blocks.append([body[len(bare) :]])
        else:
            blocks[-1].append(body)
    whole = ["".join(b) for b in blocks]
    return [b for b in whole if re.search(r"[^ \t\n\x0b\f\r]", b)], "".join(c for c, _ in kept)


PROBES = [
    "-- see /* here\nSELECT 1\nGO\n-- end */\nSELECT 2",
    "/* a /* b */ DROP TABLE t; */\nSELECT 1",
    "SELECT '/* keep */'",
    "PRINT 'a\nGO\nb'\nGO\nSELECT 1",
    "SELECT [a]]\nGO\n/*] /* x */\nGO\n\"--\nGO\n\"",
    "/* don't /*/ */ */ it's\nGO\n' -- '\nGO\nx",
    "a /* open\nGO\n'b", "'open\nGO\n/* b", "/**/*/ /*/ */ --", "\u0001\n'\u0001\n\u0001\u0002\u0003'\nGO\nx", "]]\nGO\n]",
]


def test_lexer(spark):
    random.seed(5)
    parts = ["/*", "*/", "--", "'", '"', "[", "]", "]]", "\n", "\nGO\n", "\ngo \t\r\n", "GO", "x", " ", "*", "/", "-", "é\U0001f600", "\u0001"]
    texts = PROBES + ["".join(random.choices(parts, k=random.randint(1, 40))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(8)
    rows = df.select(
        "t",
        S.strip_comments(F.col("t")).alias("rest"),
        S.split_blocks(F.col("t"), comments=False).alias("blocks"),
        S.split_blocks(F.col("t")).alias("with_comments"),
    ).collect()
    for r in rows:
        blocks, rest = lexed(r.t)
        assert (r.rest, r.blocks) == (rest, blocks), r.t
        assert r.with_comments == lexed(r.t, comments=True)[0], r.t


def test_probes(spark):
    """The statements that a pattern alone lost or made up."""
    assert one(spark, PROBES[0], lambda c: S.split_blocks(c, comments=False)) == [
        "-- see /* here\nSELECT 1\n", "\n-- end */\nSELECT 2",
    ]
    assert one(spark, PROBES[1], S.strip_comments) == "\nSELECT 1"
    assert one(spark, PROBES[2], S.strip_comments) == PROBES[2]
    assert one(spark, PROBES[3], lambda c: S.split_blocks(c, comments=False)) == ["PRINT 'a\nGO\nb'\n", "\nSELECT 1"]


@pytest.mark.parametrize("part", ["/* ", "/* */", "'", "''", "--", "[", "x\nGO\n", "/*'*/\n", "- ", "/"])
def test_long_scripts_full_of_marks(spark, part):
    text = "/* /* */ */" + part * 50_000
    blocks, rest = lexed(text)
    got = one(spark, text, lambda c: F.struct(S.strip_comments(c), F.size(S.split_blocks(c, comments=False))))
    assert tuple(got) == (rest, len(blocks))


def test_settings(spark):
    text = "/* other */\n/* [Tool]\nx=1\n*/\nselect 1"
    assert one(spark, text, lambda c: S.settings_section(c, "Tool")) == "\nx=1\n"
    assert one(spark, text, lambda c: S.without_settings(c, "Tool")) == "/* other */\n\nselect 1"
    assert one(spark, "select 1", lambda c: S.settings_section(c, "Tool")) is None


def test_long_texts_are_taken_whole(spark):
    lines = "x = '{CFG:SchemaName}'\n" * 200_000
    text = f"/* [T]\n{lines}*/a\nGO\n{lines}GO\nb"
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        F.length(S.settings_section(F.col("t"), "T")).alias("section"),
        F.transform(S.split_blocks(S.strip_comments(F.col("t"))), F.length).alias("blocks"),
        F.length(S.render(F.col("t"), F.create_map(F.lit("SchemaName"), F.lit("s")))).alias("rendered"),
    ).first()
    assert row.section == len(lines) + 1
    assert row.blocks == [2, len(lines) + 1, 2]
    assert row.rendered == len(text) - 2 * 200_000 * (len("{CFG:SchemaName}") - 1)


def test_hashes(spark):
    files = spark.createDataFrame([("f", "/*[T]a*/b"), ("g", "b")], "filename string, content string")
    f, g = scripts.script_hashes(files, "T").orderBy("filename").collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert tuple(f) == ("f", sha("/*[T]a*/b"), sha("a"), sha("b"))
    assert tuple(g) == ("g", sha("b"), None, sha("b"))


def test_blocks_and_counts(spark):
    files = spark.createDataFrame([("f", "/*\nGO\n*/a\nGO\nb"), ("g", "GO")], "filename string, content string")
    assert [tuple(r) for r in scripts.script_blocks(files).orderBy("block_no").collect()] == [
        ("f", 1, "a\n"), ("f", 2, "\nb"),
    ]
    counts = scripts.block_counts(files).orderBy("filename").collect()
    assert [tuple(r) for r in counts] == [("f", 2), ("g", 0)]


def test_render(spark):
    templates = spark.createDataFrame(
        [
            (1, "g", "OBJECT_ID('{CFG:SchemaName}.{CFG:TableBaseName}Log')"),
            (2, "g", "{CFG:Other}{CFG:SchemaName}{CFG:Other}{cfg:SchemaName}"),
            (3, "g", "nothing"),
            (4, "h", "{CFG:SchemaName}"),
            (5, "i", "{CFG:SchemaName}/{CFG:TableBaseName}/"),
        ],
        "id int, grp string, content string",
    )
    config = spark.createDataFrame(
        [("g", "app", ""), ("i", "{CFG:TableBaseName}", "$1\\b")], "grp string, s string, b string"
    )
    keys = {"SchemaName": "s", "TableBaseName": "b"}
    got = scripts.render_templates(templates, config, ["grp"], keys).collect()
    assert {r.id: (r.rendered, r.unresolved) for r in got} == {
        1: ("OBJECT_ID('app.Log')", ""),
        2: ("{CFG:Other}app{CFG:Other}{cfg:SchemaName}", "Other"),
        3: ("nothing", ""),
        4: ("{CFG:SchemaName}", "SchemaName"),
        5: ("{CFG:TableBaseName}/$1\\b/", ""),
    }


def test_drift(spark):
    path = "release_version string, target_group_alias string, filename string, file_hash string"
    before = spark.createDataFrame(
        [("r", "g", "same", "1"), ("r", "g", "old", "1"), ("r", "g", "edit", "1"), ("r", "g", "null", None)], path
    )
    after = spark.createDataFrame(
        [("r", "g", "same", "1"), ("r", "g", "new", "1"), ("r", "g", "edit", "2"), ("r", "g", "null", None)], path
    )
    got = scripts.script_drift(before, after).collect()
    assert {r.filename: r.drift for r in got} == {
        "same": "Unchanged", "old": "Removed", "new": "Added", "edit": "Changed", "null": "Unchanged",
    }


def test_resume_points(spark):
    path = "release_version string, target_group_alias string, filename string, content string"
    def files(**texts):
        return spark.createDataFrame([("r", "g", name, text) for name, text in texts.items()], path)

    before = files(same="a\nGO\nb\nGO\nc", done="a\nGO\nb", rest="a\nGO\nb\nGO\nc", prefix="a\nGO\nb", gone="a",
                   short="a\nGO\nb", none="a", comment="a /* x */\nGO\nb", grown="a", order="a\nGO\nb\nGO\nc")
    ran = F.create_map(*[F.lit(x) for pair in dict(same=2, done=9, rest=1, prefix=1, gone=0, short=2, none=0, comment=1, grown=1, order=2).items() for x in pair])
    progress = scripts.script_progress(before, F.element_at(ran, F.col("filename")))
    assert {r.filename: r.blocks_migrated for r in progress.collect()}["done"] == 2
    after = files(same="a\nGO\nb\nGO\nc", done="a\nGO\nb", rest="a\nGO\nB\nGO\nc\nGO\nd", prefix="A\nGO\nb", new="a\nGO\nb",
                  short="a", none="z\nGO\ny", comment="a /* y */\nGO\nc", grown="a\nGO\nb", order="b\nGO\na\nGO\nc", empty="")
    got = scripts.resume_points(progress, after).collect()
    assert {r.filename: (r.status, r.first_block, r.blocks_to_run) for r in got} == {
        "same": ("Unchanged", 3, 1),
        "done": ("Unchanged", None, 0),
        "rest": ("Rest changed", 2, 3),
        "prefix": ("Prefix changed", None, 0),
        "gone": ("Removed", None, 0),
        "new": ("Added", 1, 2),
        "short": ("Prefix changed", None, 0),
        "none": ("Rest changed", 1, 2),
        "comment": ("Rest changed", 2, 1),
        "grown": ("Rest changed", 2, 1),
        "order": ("Prefix changed", None, 0),
        "empty": ("Added", None, 0),
    }


def test_chain_hashes(spark):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    chain = [sha("")]
    for block in ("a", "b"):
        chain.append(sha(chain[-1] + sha(block)))
    df = spark.createDataFrame([(["a", "b"],)], "b array<string>")
    row = df.select(S.chain_hashes(F.col("b")), *[S.chain_hash(F.col("b"), n) for n in range(4)], S.chain_hash(F.col("b"))).first()
    assert list(row) == [chain, *chain, None, chain[2]]


def test_file_order_over_many_partitions(spark, conf):
    conf(
        {
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "7",
        }
    )
    # One release holds most of the files, and one file is listed twice.
    rows = [("r1" if i % 3 else "r0", "g", f"f{i}") for i in range(3000)] + [("r1", "g", "f1")]
    files = spark.createDataFrame(rows, "release_version string, target_group_alias string, filename string")
    got = scripts.file_order(files).collect()
    expected = {path: i for i, path in enumerate(sorted(set(rows)), 1)}
    assert {tuple(r)[:3]: r.file_order_id for r in got} == expected
    assert len(got) == 3000
