"""Token alignment, fill-in-middle cuts and line removal on small tables: plain versions and odd cases."""

import random
import re
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from tests.llm import brute
from tests.llm.test_operators import ODD, table

from skyair.llm import alignment, infill, linededup

# ---------------------------------------------------------------- alignment

MORE = [
    (20, "<|endoftext|> <s>[INST] <unk> </s> <0x0A> text", None),
    (21, "tabs\tand\r\nlines\n\n  spaces   \x0b\x00 end ", None),
    (22, "日本語のテキスト 🙂🙃 naïve café ﬁ Ω≈ç√ ５", None),
    (23, " leading and trailing  ", None),
    (24, "don't can't we'll THEY'RE 1234567 3.14 $5 a+b=c", None),
]


def test_alignment_equals_bytes_one_by_one(spark):
    docs = [r for r in ODD if r[0] not in (None, 1)] + MORE
    expected = brute.alignments({i: t for i, t, _ in docs})
    for frequent in (0, 40, alignment.FREQUENT_PAIRS):
        found = alignment.digest(table(spark, docs).repartition(3), frequent_pairs=frequent)
        assert {r.doc_id: {k: v for k, v in r.asDict().items() if k != "doc_id"} for r in found.collect()} == expected
    assert expected[9]["n_a"] == 0 and expected[20]["n_groups"] > 5 and expected[2]["groups_sha256"] == ""


def test_alignment_of_repeated_rows_and_empty_tables(spark):
    docs = table(spark, ODD).repartition(3)
    found = alignment.digest(docs).collect()
    assert len(found) == len(ODD) and sum(r.doc_id is None for r in found) == 2
    (one, two) = (r for r in found if r.doc_id == 1)
    assert one == two and one.n_links > 0
    assert alignment.digest(table(spark, [])).collect() == []
    kept = alignment.align(docs.select("doc_id", "text", "key", "node"))
    assert kept.columns == ["doc_id", "key", "node", *alignment._RESULTS]


def test_memo_may_be_emptied_at_any_time(spark):
    docs = table(spark, [(k, " ".join(f"w{k}{i} über" for i in range(50)), None) for k in range(40)])
    small, large = (
        {r.doc_id: (r.groups, dict(zip(r.pairs, r.times))) for r in alignment.align(docs, memo_bytes=n).collect()}
        for n in (1, alignment.MEMO_BYTES)
    )
    assert small == large


def test_windows_are_cut_at_anchors_only():
    aligner = alignment.Aligner(alignment.load_tokenizers())
    n_a, n_b, found, per_text = aligner.windows(["one two three", None, "", "four"])
    assert per_text.tolist() == [3, 0, 0, 1] and len(set(found)) == 4
    again = aligner.windows(["three two one"])[2]
    assert set(again) < set(found)  # known windows are looked up


def test_both_byte_libraries_give_the_same_ids():
    tokenizer = alignment.ByteTokenizer(alignment.load_tokenizers().byte_file)
    assert tokenizer.fast is not None
    rng = random.Random(5)
    signs = "aAzé ß\n\t\r  '’0123.,!?<|>endoftext|日本語🙂  \x00́"
    for _ in range(400):
        text = "".join(rng.choices(signs, k=rng.randrange(60)))
        assert tokenizer.fast.encode_ordinary(text) == tokenizer.slow.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------- cuts


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_cuts_equal_counting_from_the_start(block):
    rng = random.Random(block)
    for _ in range(60):
        text = "".join(rng.choices("ab é日🙂\n", k=rng.randrange(40)))
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        tree = infill.BlockTree(data, block=block)
        assert tree.n_units == tree.n_points == len(text)
        for rank in range(len(text) + 1):
            assert tree.cut(rank) == (len(text[:rank].encode()), rank)
        starts = sorted({0, *(m.start() for m in re.finditer(r"\S+\s*", text))}) if text else []
        words = infill.BlockTree(data, infill.unit_starts(data, re.compile(r"\S+\s*")), block)
        assert words.n_units == len(starts)
        for rank, at in enumerate([*starts, len(text)]):
            assert words.cut(rank) == (len(text[:at].encode()), at)


def plain_infill(key, text):
    text = text or ""
    h = [int(sha256(f"1:{'' if key is None else key}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_infill_equals_plain_version_and_restores(spark):
    marked = [(30 + k, t, None) for k, t in enumerate(["a <P> b", "x<S>", "<M>", "< P>", "<<P", "S>M><", "<P"])]
    many = [(100 + k, f"text é number {k} <S", None) for k in range(80)]
    docs = [*ODD, *marked, *many]
    found = infill.transform(table(spark, docs).repartition(3)).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()
    expected = sorted(((i, len(t or ""), *plain_infill(i, t)) for i, t, _ in docs), key=repr)
    assert sorted(map(tuple, found), key=repr) == expected
    assert {f for _, _, f, *_ in expected} == {"plain", "psm", "spm"}
    back = infill.digest(infill.transform(table(spark, docs))).collect()
    assert sorted((r.restored_sha256 for r in back)) == sorted(sha256((t or "").encode()).hexdigest() for _, t, _ in docs)
    assert infill.transform(table(spark, [])).collect() == []


def test_infill_by_words(spark):
    docs = [(k, f"  one twö three four {k}", None) for k in range(40)]
    for r in infill.transform(table(spark, docs), pattern=r"\S+\s*").filter("form = 'psm'").collect():
        prefix, suffix, middle = re.fullmatch(r"(?s)<P>(.*)<S>(.*)<M>(.*)", r.output).groups()
        assert prefix + middle + suffix == docs[r.doc_id][1] and r.n == 6
        assert (len(prefix), len(middle)) == (r.prefix_chars, r.middle_chars)
        assert prefix == "" or prefix[-1] == " " or not suffix + middle


# ---------------------------------------------------------------- lines


def plain_lines(docs, least=40, documents=5):
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(-1 if i is None else i)
    again = {k: max(v) for k, v in holders.items() if len(v) >= documents}
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if again.get(key(x), i) == i]
        yield i, len(lines), len(lines) - len(kept), "\n".join(kept)


SHARED = ["This line stands in many documents, and it is long.", "Ünd diese Zeile ist ében so läng wie die ändere!", "y" * 40, "z" * 39]


def removed(docs):
    return linededup.apply(docs, linededup.keep_bitmaps(docs))


def test_lines_equal_plain_version(spark):
    rng = random.Random(8)
    texts = []
    for k in range(120):
        lines = [rng.choice([*SHARED, SHARED[0].upper(), "\t " + SHARED[2] + "\x0b\r", " " + SHARED[0], f"own {k}", "", "x" * 50 + str(k % 30)])
                 for _ in range(rng.randrange(9))]
        texts.append((rng.randrange(90) if k % 10 else None, "\n".join(lines)))
    docs = [(i, t, None) for i, t in texts] + ODD
    found = removed(table(spark, docs).repartition(5)).select("doc_id", "n_lines", "n_dropped", "text").collect()
    expected = list(plain_lines([(i, t) for i, t, _ in docs]))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert sum(e[2] for e in expected) > 100


def test_bitmaps_are_runs_of_kept_lines(spark):
    gone = SHARED[0]
    docs = [(k, "\n".join([gone, "a", "b", gone, gone, "c"]), None) for k in range(5)] + [(9, None, None), (10, gone, None), (3, "more", None)]
    bitmaps = linededup.keep_bitmaps(table(spark, docs))
    rows = sorted((r.document, r.n_lines, r.n_dropped, [tuple(x) for x in r.keep]) for r in bitmaps.collect())
    runs = [(1, 2), (5, 1)]
    assert rows == [
        (0, 6, 3, runs), (1, 6, 3, runs), (2, 6, 3, runs), (3, 1, 0, [(0, 1)]), (3, 6, 3, runs), (4, 6, 3, runs),
        (9, 1, 0, [(0, 1)]), (10, 1, 0, [(0, 1)]),
    ]
    assert removed(table(spark, [])).collect() == []
    columns = removed(table(spark, docs)).columns
    assert columns[0] == "doc_id" and {"key", "hash", "size", "text", "n_lines"} <= set(columns)


def test_a_hot_line_is_counted_over_cells(spark):
    docs = [(k, f"{SHARED[0]}\nown line {k}", None) for k in range(20_000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(8)
    rows = removed(df).groupBy("n_dropped").count().collect()
    assert {(r.n_dropped, r["count"]) for r in rows} == {(1, 19_999), (0, 1)}
