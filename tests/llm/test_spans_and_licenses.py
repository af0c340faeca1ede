"""License scan against SQL brute force, sentence spans against a plain dictionary."""

import hashlib
import random
import re

import duckdb
import xxhash

from eventflow.llm import licenses, sentence_spans
from eventflow.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import rows_of
from tests.llm.test_texts import ODD, PROSE, by_row

RNG = random.Random(11)
NOTICES = [n for _, n in licenses.TEMPLATES]


def test_op4_equals_every_block_against_every_template(spark, documents):
    words = sorted({w for n in NOTICES for w in licenses.template_words(n)}) + ["x", "é", "\n", ". ", "; "]
    texts = ODD + NOTICES + [" ".join(RNG.choices(words, k=RNG.randint(1, 40))) for _ in range(400)]
    texts += [f"{PROSE[0]}\n{n}\n{PROSE[1]}" for n in NOTICES] + ["CC BY cc-by, All Rights\treserved", "cc by cc by", "general public license"]
    for n in NOTICES:
        w = n.split()
        RNG.shuffle(w)
        texts += [" ".join(w), " ".join(w[1:]), n + " " + PROSE[2]]
    folder = documents(texts)
    got = QUERIES["op4_licenses"](spark, folder)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    want = con.sql(ORACLE["op4_licenses"])
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert got.columns == cols
    rows = sorted((tuple(r) for r in want.select(*cols).fetchall()), key=repr)
    assert by_row(got, *cols) == rows
    assert sum("apache" in r[6] for r in rows) >= 3 and any(r[6] and not r[5] for r in rows)


def sql_rows(folder, sql):
    cols = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    con = duckdb.connect()
    con.sql(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    return sorted((tuple(r) for r in con.sql(sql).select(*cols).fetchall()), key=repr), cols


def wrapped(text, width, sign):
    """The text over lines of ``width`` words, each after the first led by a comment sign."""
    w = text.split(" ")
    return ("\n" + sign).join(" ".join(w[i:i + width]) for i in range(0, len(w), width))


def test_op4_equals_its_sql_on_wrapped_notices(spark, documents):
    signs = ["", "# ", " * ", "// ", ";; ", "    % ", "-- ", "\t"]
    texts = [f"{PROSE[k % 9]}\n{RNG.choice(['', chr(10)])}{sign}{wrapped(n, RNG.randint(2, 9), sign)}{RNG.choice(['. ', '; ', chr(10) * 2, ' '])}{PROSE[3]}"
             for k, n in enumerate(NOTICES) for sign in signs]
    folder = documents(texts)
    want, cols = sql_rows(folder, ORACLE["op4_licenses"])
    assert by_row(QUERIES["op4_licenses"](spark, folder), *cols) == want
    assert sum(r[6] != "" for r in want) > len(texts) * 0.7


def whole_licences(n):
    """Made-up licences of the usual shape: a title, numbered paragraphs of several sentences, some shared by two."""
    rng = random.Random(4)
    words = [f"term{i}" for i in range(400)] + ["the", "of", "and", "to", "or", "any", "this"] * 30
    sentence = lambda: " ".join(rng.choices(words, k=rng.randint(3, 60)))
    shared = [sentence() for _ in range(6)]
    out = []
    for k in range(n):
        paragraphs = [f"{i}. " + ". ".join([sentence() for _ in range(rng.randint(1, 5))] + [rng.choice(shared)]) + "." for i in range(rng.randint(4, 20))]
        out.append((f"licence-{k}", f"Licence {k}\nVersion {k}.0\n\n" + "\n\n".join(paragraphs)))
    return out


def test_op4_whole_licences_as_a_table(spark, documents):
    licences = [*whole_licences(10), ("short", "All yours"), ("nothing", " . ")]
    texts = [t for _, t in licences]
    texts += [wrapped(t.replace("\n\n", " \x01 "), 9, "# ").replace("\x01", "\n#\n#") for _, t in licences[:4]]  # a wrapped header
    for label, t in licences[:6]:  # one clause in a document, some words changed
        clause = RNG.choice(t.split("\n\n")[1:])
        changed = " ".join("x" if RNG.random() < 0.06 else w for w in clause.split(" "))
        texts += [f"{PROSE[1]}\n\n{clause}\n\n{PROSE[2]}", f"{PROSE[1]}\n\n{changed}"]
    folder = documents(texts + PROSE)
    want, cols = sql_rows(folder, licenses.oracle_sql(licences))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    table = spark.createDataFrame(licences, "name string, body string")
    got = licenses.scan(docs, templates=table)
    assert by_row(got, *cols) == want and len({r[6] for r in want}) > 6
    plan = got._jdf.queryExecution().toString()
    assert "term17" not in plan and not any(w in plan for w in ("Python", "Arrow", "Cartesian", "NestedLoop"))


def test_op4_finds_wrapped_notices(spark, documents):
    mit, bsd = NOTICES[2].split(), NOTICES[6].split()
    lines = [(" ".join(w[:n]), " ".join(w[n:])) for w, n in ((mit, 13), (bsd, 10))]
    texts = [f"{PROSE[0]}\n\n{a}{gap}{b}\n\n{PROSE[1]}" for a, b in lines for gap in ("\n", "\r\n", "\n * ", "\n# ", "\n    // ", "\n;; ")]
    apart = [f"{a}{gap}{b}" for a, b in lines for gap in ("\n\n", "\n #\n# ", ". ", ";\n")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in QUERIES["op4_licenses"](spark, documents(texts + apart)).collect()}
    assert [got[i] for i in range(len(texts))] == [("mit", 1.0)] * 6 + [("bsd", 1.0)] * 6
    assert all(got[len(texts) + i] == ("", 0.0) for i in range(len(apart)))


def test_op4_runs_no_python(spark, documents):
    plan = QUERIES["op4_licenses"](spark, documents(ODD))._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def plain_pieces(text):
    """[(start, end, words, whether it begins a sentence)]: sentences one regular expression match at a time, cut behind the
    word of the smallest XXH64 (the last of equals) of every six words of a sentence."""
    out, a = [], 0
    for m in re.finditer(rb"[^.!?\n]*[.!?\n]+[\x20\t\r\x0b\x0c]*|[^.!?\n]+", text):
        words = [(w.group(1).lower(), m.start() + w.end()) for w in re.finditer(rb"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*", m.group())]
        if not words:
            continue
        order = [xxhash.xxh64_intdigest(w) for w, _ in words]
        cuts = {max(range(i, i + 6), key=lambda k: (-order[k], k)) for i in range(len(words) - 5)}
        own, first = [], True
        for k, (w, end) in enumerate(words):
            own.append(w)
            if k == len(words) - 1:
                end = m.end()
            elif k not in cuts:
                continue
            out.append((a, end, own, first))
            a, own, first = end, [], False
    if a < len(text):
        out = [*out[:-1], (out[-1][0], len(text), *out[-1][2:])] if out else [(0, len(text), [], True)]
    return out


def plain_dedup(rows):
    docs = {(r[0], r[1] or "") for r in rows}
    seen = {}
    for i, t in docs:
        cut = plain_pieces(t.encode())
        assert [(a, b, len(w)) for a, b, w, _ in cut] == sentence_spans.pieces(t.encode())
        assert b"".join(t.encode()[a:b] for a, b, _, _ in cut) == t.encode()
        heads = [k for k, c in enumerate(cut) if c[3]] + [len(cut)]
        spans = []
        for k in range(len(cut)):  # five pieces and eighteen words
            n = next((n for n in range(5, len(cut) - k + 1) if sum(len(c[2]) for c in cut[k:k + n]) >= 18), 0)
            spans += [(k, n, "p")] * (n > 0)
        spans += [(heads[j], heads[j + 3] - heads[j], "s") for j in range(len(heads) - 3)]
        for k, n, kind in spans:
            seen.setdefault((kind, b" ".join(w for s in cut[k:k + n] for w in s[2])), []).append((i is None, i or 0, t, k, n))
    gone = {}
    for places in seen.values():
        # the text's digest orders rows of one id
        order = lambda p: (p[0], p[1], signed_digest(p[2]), p[3])
        for none, i, t, k, n in sorted(places, key=order)[1:]:
            gone.setdefault((None if none else i, t), set()).update(range(k, k + n))
    out = []
    for r in rows:
        t = (r[1] or "").encode()
        drop = gone.get((r[0], r[1] or ""), set())
        kept = b"".join(t[c[0]:c[1]] for k, c in enumerate(plain_pieces(t)) if k not in drop)
        out.append((r[0], len(t), len(t) - len(kept), len(drop), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def signed_digest(t):
    x = xxhash.xxh64_intdigest(t.encode(), 42)
    return x - (1 << 64) if x >> 63 else x


def prose(n, punctuation):
    return " ".join(w + (RNG.choice(punctuation) if RNG.random() < 0.15 else "") for w in RNG.choices([f"v{i}" for i in range(3000)], k=n))


def test_op7_equals_plain_dictionary(spark, documents):
    texts = ODD + [prose(200, [".", ",", "!\n"]) for _ in range(20)]
    shared = [prose(60, p) for p in (["."], [","], [" "], [".", "\n"]) for _ in range(3)]
    planted = []
    for k, s in enumerate(shared):
        for _ in range(3):
            planted.append(len(texts))
            texts.append(prose(40, [".", " "]) + " " + s + " " + prose(40, [".", " "]))
    texts += [texts[20], texts[21], shared[0] + ". " + shared[0]]
    got = QUERIES["op7_sentence_spans"](spark, documents(texts))
    rows = rows_of(texts)
    assert by_row(got, "doc_id", "n_bytes", "n_removed", "n_pieces_removed", "kept_sha256") == plain_dedup(rows)
    removed = {r["doc_id"]: r["n_removed"] for r in got.collect()}
    for k, i in enumerate(planted):  # the first of each three keeps its passage
        assert (removed[i] > 0) == (k % 3 > 0)


def removed_by_doc(spark, folder):
    return {r["doc_id"]: r["n_removed"] for r in QUERIES["op7_sentence_spans"](spark, folder).collect()}


def test_op7_short_sentences_and_unpunctuated_passages(spark, documents):
    """What the rule promises: three sentences of seven words, a line of three sentences, any 51 words in a row."""
    own = lambda n: " ".join(f"u{RNG.randrange(10 ** 9)}" for _ in range(n))
    texts, want = ["first. " + own(3)], {0: False}
    for _ in range(40):  # pairs
        three = ". ".join(own(7) for _ in range(3)) + "."
        for k in range(2):
            want[len(texts)] = k == 1
            texts.append(f"{own(9)}. {three} {own(12)}.")
    line = "Sign up now. It is free! Really?"
    for k in range(20):
        want[len(texts)] = k > 0
        texts.append(f"{own(30)}\n{line}\n{own(11)}")
    for _ in range(60):
        passage = own(51)
        for k in range(2):
            want[len(texts)] = k == 1
            texts.append(f"{own(RNG.randint(0, 40))} {passage} {own(RNG.randint(0, 40))}")
    for _ in range(20):
        want[len(texts)] = False
        texts.append(". ".join(own(RNG.randint(1, 30)) for _ in range(6)))
    got = removed_by_doc(spark, documents(texts))
    assert {i: got[i] > 0 for i in want if i} == {i: x for i, x in want.items() if i}


def test_op7_long_text(spark, documents):
    body = prose(120_000, [".", " ", ","])
    got = removed_by_doc(spark, documents(["x", body, "start. " + body[50_000:60_000] + " end", "again " * 60_000]))
    assert got[1] == 0 and 9_800 < got[2] <= 10_000 and got[3] > 350_000


def test_empty_tables(spark, no_documents):
    for name in ("op4_licenses", "op7_sentence_spans"):
        assert QUERIES[name](spark, no_documents).count() == 0
