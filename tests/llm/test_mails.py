"""Mail decoding, leak search and text quality."""

from __future__ import annotations

import base64
import quopri
import random

import numpy as np
from pyspark.sql import functions as F

from queuescope.llm.leak import RUN, leaks, words_of
from queuescope.llm.mailtext import html_to_text, parts, undo_base64, without_quote_marks
from queuescope.llm.quality import BOILERPLATE_SHARE, KINDS, TAIL_WORDS, fit, frequent_shingles, label_lines, line_shape, own_lines, own_texts, quality, without_boilerplate

HEAD = "From: A B <a@b.invalid>\nSubject: Hello\nMIME-Version: 1.0\n"


def mail(body, kind="text/plain; charset=utf-8", coding="8bit"):
    if coding == "base64":
        body = base64.encodebytes(body.encode()).decode()
    elif coding == "quoted-printable":
        body = quopri.encodestring(body.encode()).decode()
    return f"{HEAD}Content-Type: {kind}\nContent-Transfer-Encoding: {coding}\n\n{body}"


def multipart(*sections, kind="mixed"):
    inner = "".join(f"--=_b1\nContent-Type: {k}\nContent-Transfer-Encoding: 8bit\n\n{b}\n" for k, b in sections)
    return f"{HEAD}Content-Type: multipart/{kind};\n\tboundary=\"=_b1\"\n\nignored\n{inner}--=_b1--\n"


def test_parts_are_decoded():
    said = "Grüße aus dem Café = 5 > 3\nzweite Zeile"
    for coding in ("8bit", "base64", "quoted-printable"):
        assert [p.text.strip() for p in parts(mail(said, coding=coding))] == [said]
    assert parts(mail("<p>Tom &amp; Ann<br>two</p><style>x{}</style><td>a</td>", "text/html"))[0].text.split() == ["Tom", "&", "Ann", "two", "a"]
    many = parts(multipart(("text/plain", "one"), ("text/html", "<b>two</b>"), ('text/plain; name="x.txt"', "three"), ('application/octet-stream; name="y"', "AAAA")))
    assert [(p.kind, p.attached, p.text.strip()) for p in many] == [("plain", False, "one"), ("html", False, "two"), ("plain", True, "three")]


def test_broken_mails_are_read_as_far_as_they_go():
    assert parts(None) == parts("") == []
    assert parts("no headers at all")[0].text == ""
    assert parts("\nbody only")[0].text == "body only"
    assert parts(mail("QUJD!!!", coding="base64").replace("UVVKREkhIQ==", "QUJD"))
    assert parts(HEAD + "Content-Type: multipart/mixed; boundary=zz\n\n--zz\nContent-Type: text/plain\n\nopen end")[0].text.strip() == "open end"
    assert parts((HEAD + "\r\nContent-Type: text/plain\r\n\r\nwindows").replace("\n\r", "\r"))
    deep = "x"
    for i in range(60):
        deep = f"Content-Type: multipart/mixed; boundary=b{i}\n\n--b{i}\n{deep}\n--b{i}--"
    parts(deep)
    assert html_to_text("a<b and c>d") != ""
    assert len(parts(mail("word " * 200_000))[0].text) == 1_000_000


def test_quote_marks():
    assert without_quote_marks("> > a b\n>> c\n| d\n>e\nplain > not").split("\n") == ["a b", "c", "d", "e", "plain > not"]


WORDS = [f"w{i}" for i in range(40)]


def _corpus(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.choice([5, 11, 12, 30, 45])))) for i in range(25)] + [(90, None), (91, ""), (92, "Same " * 40)]
    items += [(93, items[3][1]), items[4], (4, " ".join(rng.choice(WORDS) for _ in range(30)))]
    documents = []
    for i in range(60):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            source = words_of(rng.choice(items)[1] or "")
            if source:
                at, n = rng.randrange(max(1, len(source) - 12)), rng.choice([11, 12, 13, 40])
                place = rng.randrange(len(words) + 1)
                words[place:place] = [w.upper() for w in source[at : at + n]]
        lines = [" ".join(words[k : k + 7]) for k in range(0, len(words), 7)]
        body = "\n".join(rng.choice(["", "> ", "> > ", "| "]) + x for x in lines)
        documents.append((i, mail(body, coding=rng.choice(["8bit", "base64", "quoted-printable"]))))
    return items, documents + [(100, None), (101, ""), (102, mail("same " * 5000)), (103, documents[0][1])]


def test_leaks_equal_brute_force(spark):
    for seed in (1, 2):
        items, documents = _corpus(seed)
        windows: dict[tuple, set] = {}
        for i, text in items:
            w = words_of(text or "")
            for k in range(len(w) - RUN + 1):
                windows.setdefault(tuple(w[k : k + RUN]), set()).add(i)
        want = set()
        for d, text in documents:
            for part in parts(text):
                w = words_of(without_quote_marks(part.text))
                for k in range(len(w) - RUN + 1):
                    want |= {(d, i) for i in windows.get(tuple(w[k : k + RUN]), ())}
        docs = spark.createDataFrame(documents, "doc_id long, text string").withColumn("item", F.lit("clash")).withColumn("shingle", F.lit("clash"))
        its = spark.createDataFrame(items, "item_id long, text string").withColumn("doc", F.lit("clash"))
        # a tiny filter lets nearly everything through: the result must not change
        for bits in (24, 8):
            assert {(r["doc"], r["item"]) for r in leaks(docs, its, bits=bits).collect()} == want
        assert len(want) > 10
    assert leaks(docs.where(F.lit(False)), its).count() == 0
    assert leaks(docs, its.where(F.lit(False))).count() == 0


PROSE = "I think every narrow panel reviewed this station before the old visitor came. It was late.\nAnother evening the crowd waited for the boats, and nobody knew why.\n"
LIST = "\n".join(f"- {a} {b}" for a, b in zip("alpha bravo carton delta easel fjord gamma hotel".split(), "red tall blue long grey thin wide new".split(), strict=True))
TABLE = "name\tjune\tjuly\n" + "\n".join(f"row{i}\t{i * 37}\t{i}.5" for i in range(9))
HEX = "\n".join(f"{i * 16:08x}  " + " ".join(f"{(i * 31 + j * 7) % 256:02x}" for j in range(16)) for i in range(8))
RANDOM = "\n".join("xkq vbrtz qpdfg hjklm zxcvb wrtpq" for _ in range(6))


def test_own_lines_leave_the_rest_out():
    body = PROSE + "\nRegards\nAnn Bee\nTel +1 555-0100 / 1 Road\n\nJoe Doe wrote:\n\n> quoted text here\n> - item\n"
    prose = PROSE.strip().split("\n")
    assert [x for x in own_lines(mail(body)) if x.strip()] == prose
    assert [x for x in own_lines(mail("> quoted\n\n" + PROSE + "-- \nAnn\n")) if x.strip()] == prose
    assert [x for x in own_lines(mail("-----Original Message-----\nFrom: X\n\nHello all,\n\nold text\n\nRegards\nX Y\n\n" + PROSE)) if x.strip()] == prose
    assert [x for x in own_lines(mail("| a | b |\n|---|---|\n| 1 | 2 |")) if x.strip()] == ["| a | b |", "|---|---|", "| 1 | 2 |"]
    assert own_lines(None) == own_lines("") == []


def test_own_lines_are_of_all_inline_parts():
    two = multipart(("text/plain", PROSE), ('text/plain; name="x.txt"', "attached"), ("text/plain", LIST), ("message/rfc822", f"{HEAD}\nforwarded"))
    assert [x for x in own_lines(two) if x.strip()] == [*PROSE.strip().split("\n"), *LIST.split("\n")]
    either = multipart(("text/html", "<p>marked</p>"), ("text/plain", "plain"), kind="alternative")
    assert [x for x in own_lines(either) if x.strip()] == ["plain"]
    assert [x.strip() for x in own_lines(multipart(("text/html", "<p>marked</p>"), kind="alternative")) if x.strip()] == ["marked"]


def test_base64_is_read_run_by_run():
    first, second = (base64.b64encode(t.encode()).decode() for t in ("one sentence here.\n", "and a second run of words.\n"))
    assert undo_base64(f"{first}\n{second}\n") == "one sentence here.\nand a second run of words.\n"
    assert undo_base64(f"{first}\n\n_______\nA list of the park, for all\nUnsubscribe\n").split("\n") == ["one sentence here.", "", "_______", "A list of the park, for all", "Unsubscribe", ""]
    assert undo_base64(f"{first[:9]}\n{first[9:]}") == "one sentence here.\n"
    assert undo_base64("no encoding at all") == "no encoding at all\n"


def test_boilerplate_is_what_many_mails_end_with(spark):
    rng = random.Random(4)
    notice = "Whoever finds this letter on the beach is kindly asked to bring it back to the lighthouse before the tide."
    rows = []
    for i in range(60):
        lines = [" ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(9)) + "." for _ in range(2)]
        words, width = notice.split(), rng.choice([4, 7, 30])
        wrapped = [" ".join(words[k : k + width]) for k in range(0, len(words), width)]
        rows.append((i, mail("\n".join([*lines, "", *(wrapped if i % 2 else []), f"Badge {i * 37} of the north gate, issued on {i}/7/2020"]))))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    own = own_texts(frame).cache()
    frequent = frequent_shingles(own)
    assert 0 < len(frequent) <= TAIL_WORDS / BOILERPLATE_SHARE
    for r in own.collect():
        assert without_boilerplate(r["lines"], frequent) == r["lines"][:2]
    assert frequent_shingles(own.limit(9)) == frozenset()  # too few mails to tell
    assert {r["n_lines"] for r in quality(frame).collect()} == {2}


def test_kinds(spark):
    bodies = {
        "prose": [PROSE, PROSE * 40, PROSE + "- one\n- two\n" + PROSE, "Yes, that is fine with me.", "", "Dear all,\n\n" + PROSE],
        "list": [LIST, "We need these for the trip:\n" + LIST],
        "table": [TABLE, TABLE.replace("\t", ";"), TABLE.replace("\t", ","), "\n".join(f"{'item' + str(i):<12}{i * 91:<10}{i * 7.5:<10}" for i in range(9))],
        "junk": [HEX, RANDOM, "\n".join("%&*@#!~" * 6 for _ in range(8)), "\n".join("boat " * 12 for _ in range(8)), "\n".join(base64.b64encode(bytes((i * j) % 256 for j in range(45))).decode() for i in range(3, 14))],
    }
    rows = [(i, mail(body), kind) for i, (kind, body) in enumerate((k, b) for k, bs in bodies.items() for b in bs)]
    rows += [(900, None, "prose"), (901, "", "prose")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, expected string").withColumn("kind", F.lit("clash"))
    got = {r["doc_id"]: r for r in quality(frame).collect()}
    assert {i: (got[i]["kind"], want) for i, _, want in rows if got[i]["kind"] != want} == {}
    assert got[900]["n_words"] == 0 and got[900]["mean_word_length"] is None
    first = got[0]
    words = words_of(PROSE)
    assert first["n_words"] == len(words) and abs(first["mean_word_length"] - sum(map(len, words)) / len(words)) < 1e-9
    assert first["share_lines_ending_punct"] == 1.0 and 0.2 < first["share_common_words"] < 0.8
    assert quality(frame.where(F.lit(False))).count() == 0


def test_labels_equal_a_plain_viterbi():
    rng = random.Random(3)
    pool = [line_shape(x).symbol for x in (PROSE + LIST + "\n" + TABLE + "\n" + HEX).split("\n") if x.strip()]
    mails = [[rng.choice(pool) for _ in range(rng.randrange(0, 12))] for _ in range(30)]
    model = fit(mails)
    for symbols, got in zip(mails, label_lines(mails, model), strict=True):
        paths = {(): 0.0}
        best = {k: (model.start[k] + model.emit[k, symbols[0]], (k,)) for k in range(4)} if symbols else {}
        for s in symbols[1:]:
            best = {k: max((v + model.move[j, k] + model.emit[k, s], p + (k,)) for j, (v, p) in best.items()) for k in range(4)}
        assert paths and list(got) == (list(max(best.values())[1]) if best else [])
    assert len(KINDS) == 4 and np.allclose(np.exp(model.start).sum(), 1)
