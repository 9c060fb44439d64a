"""Per-mail text statistics, and whether its own text is prose, a list, a table or junk.

Method: a hidden Markov model labels every line of the own text from the line's
statistics; the labels' shares decide.  The model is trained here on the lines
of a bounded sample of mails (``sample_docs``): it starts from the lines whose
shape is beyond doubt and is refined by hard expectation-maximisation, in which
the lines in doubt take the labels of the model so far and are counted with them.
The statistics themselves are computed for all mails in full.

Disclaimers, footers and signatures are not known by their words: a line is boilerplate when its
words stand in five-word shingles that the ends of many mails share.  The shingles are counted over
all mails; a mail gives at most ``TAIL_WORDS`` of them, so those in a share ``BOILERPLATE_SHARE`` of the mails
are at most TAIL_WORDS / BOILERPLATE_SHARE, which is all that is collected and broadcast.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuescope.llm.mailtext import inline_texts
from queuescope.session import cut, spread

KINDS = ("prose", "list", "table", "junk")
#: Mails the model is fitted on at most.
SAMPLE_DOCS = 2000
#: Rounds of expectation-maximisation.
ROUNDS = 3
#: Words at the end of a mail's own text in which boilerplate is looked for, and words of a shingle.
TAIL_WORDS, SHINGLE = 60, 5
#: Share of all mails that have a shingle at their end from which it is boilerplate, and the least number of mails.
BOILERPLATE_SHARE, BOILERPLATE_MAILS = 0.02, 10
#: Share of a line's words that stand in such shingles from which the line is left out.
COVERED = 0.7
#: Words of two letters or more that a shingle needs, so that rows of numbers are never boilerplate.
LEAST_LETTERED = 3

# Frequent function words of English, German, French and Spanish.
COMMON_WORDS = frozenset(
    """the a an and or but of to in on at for with from by this that these those some every each your our their my his her its is are was were be
    been has have had will would can could should not no as if when while after before about into over under we you they he she it i one another
    der die das den dem ein eine einen einem einer und oder aber mit von zu im in auf für ist sind war nicht wie wenn nach vor über unter wir sie er
    es ich dieser diese dieses jeder jede unser unsere le la les un une des du de et ou mais avec pour par sur dans est sont ce cette ces chaque notre
    votre que qui ne pas el los las una del y o pero con por para en es son este esta cada nuestro nuestra se lo""".split()
)

_MARKED = re.compile(r"^[ \t]*(?:>|\|(?:[ \t>|]|(?=[^\W\d_])))")
_PIPE_ROW = re.compile(r"^\s*\|.*\|\s*$")
_WROTE = re.compile(r"^\s*\S.{0,200}\b(?:wrote|schrieb|a écrit|écrit|escribió)\s*:\s*$", re.I)
_ORIGINAL = re.compile(r"^\s*-{2,}\s*(?:original message|forwarded message|ursprüngliche nachricht|message d'origine|mensaje original)\s*-{2,}\s*$", re.I)
_FIELD = re.compile(r"^(?:from|to|cc|date|sent|subject|von|an|betreff|de|objet|asunto)\s*:", re.I)
_SIGNATURE = re.compile(r"^--\s*$")
_CLOSING = re.compile(r"^\s*(?:(?:best|kind|warm|with) )?(?:regards|wishes|thanks|cheers|sincerely|many thanks|viele grüße|mit freundlichen grüßen|gruß|cordialement|bien à vous|saludos|un saludo|atentamente)\s*[,.!]?\s*$", re.I)
_GREETING = re.compile(r"^\s*(?:[^\W\d_]+\s){0,2}[^\W\d_]+,\s*$")
# Labels of telephone numbers in English, German, French and Spanish.
_CONTACT = re.compile(r"^\s*(?:tel|telephone|phone|fax|mobile|cell|telefon|handy|tél|téléphone|portable|teléfono|móvil)\b\.?:?\s*[+(\d]", re.I)
_BULLET = re.compile(r"^\s*(?:[-*+•·‣o]|\(?\d{1,4}[.)]|[a-zA-Z][.)])\s+\S")
_ALIGNED = re.compile(r"\S(?: {2,}|\t)\S")
_WORD = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(r"^[-+]?[\d.,:%x/]*\d[\d.,:%]*$")
_VOWEL = re.compile(r"[aeiouyà-ÿœ]", re.I)
_HEX = re.compile(r"^[0-9a-fA-F]{4,}[: ]+(?:[0-9a-fA-F]{2,4}[ ]+){4,}")
_HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
_CONTROL = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f]")
_BROKEN = re.compile("[�\x80-\x9f]|Ã[\x80-\xbf‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ¡-¿]|â€|Â[ -¿]")
_ENDS = (".", "!", "?", ":", ";", ",", '"', "”", "»", "…", ")")


def own_lines(text: str | None) -> list[str]:
    """The lines a mail's writer wrote, boilerplate included: no headers, quoted mails, signature, attachments.

    All inline text parts are read, of alternatives one; null or empty mails have no lines.
    """
    kept: list[str] = []
    for shown in inline_texts(text):
        kept += _unquoted(shown)
    return kept


def _unquoted(text: str) -> list[str]:
    kept: list[str] = []
    quoting = closed = below = greeted = False
    for line in text.split("\n"):
        if _ORIGINAL.match(line):
            # unmarked quotes run to the end; where nothing stands above, to the quoted writer's closing or the next greeting
            below = not any(x.strip() for x in kept)
            quoting, greeted = True, False
            continue
        if quoting:
            if below and _CLOSING.match(line):
                quoting, closed, below = False, True, False
            elif below and _GREETING.match(line):
                quoting, greeted = not greeted, True
                if not quoting:
                    kept.append(line)
            continue
        if _WROTE.match(line):
            closed = False
            continue
        if _MARKED.match(line) and not _PIPE_ROW.match(line):
            closed = False
            continue
        if closed:
            # the name and contact lines after a closing; a longer line begins new text
            if line.strip() and len(_WORD.findall(line)) > 6:
                closed = False
            else:
                continue
        if _SIGNATURE.match(line) or _CLOSING.match(line):
            closed = True
            continue
        if _CONTACT.match(line):
            continue
        kept.append(line)
    return kept


_TOKEN = re.compile(r"\d+|[^\W\d_]+")


def _tail(lines: list[str]) -> tuple[list[int], list[int]]:
    """The hashes of the shingles in the last words of the lines (numbers are alike; 0 for shingles of too few lettered words), and the line of each word."""
    words: list[str] = []
    owner: list[int] = []
    for at in range(len(lines) - 1, -1, -1):
        found = _TOKEN.findall(lines[at].lower())[-(TAIL_WORDS - len(words)) :]
        words[:0] = ["0" if w[0].isdigit() else w for w in found]
        owner[:0] = [at] * len(found)
        if len(words) >= TAIL_WORDS:
            break
    digest = xxhash.xxh64_intdigest
    lettered = [len(w) > 1 for w in words]
    return [digest(" ".join(words[i : i + SHINGLE])) - (1 << 63) if sum(lettered[i : i + SHINGLE]) >= LEAST_LETTERED else 0 for i in range(len(words) - SHINGLE + 1)], owner


def without_boilerplate(lines: list[str], frequent: frozenset[int]) -> list[str]:
    """The lines without those at the end whose words stand in frequent shingles."""
    shingles, owner = _tail(lines)
    covered = [False] * len(owner)
    for i, shingle in enumerate(shingles):
        if shingle in frequent:
            covered[i : i + SHINGLE] = [True] * SHINGLE
    if not any(covered):
        return lines
    words, hits = Counter(owner), Counter(at for at, hit in zip(owner, covered, strict=True) if hit)
    return [line for at, line in enumerate(lines) if hits[at] < COVERED * words[at] or not words[at]]


class LineShape(NamedTuple):
    """Statistics of a line, and the symbol that the model sees."""

    words: int
    letters: int
    symbols: int
    common: int
    size: int
    symbol: int


#: Fields of a symbol and their number of values.
_FIELDS = (("layout", 7), ("length", 4), ("sense", 6), ("numbers", 3), ("end", 3))
N_SYMBOLS = int(np.prod([n for _, n in _FIELDS]))
_SPLIT = re.compile(r"[\s,;|]+")
_DIGITS = "0123456789"


def _layout(line: str, bare: str, tokens: list[str]) -> int:
    """0 running text, 1 tabs or pipes, 2 fields parted by commas or semicolons, 3 aligned columns, 4 bullet, 5 dump, 6 one long token."""
    if bare[0] in _HEX_DIGITS and _HEX.match(bare):
        return 5
    commas, semis, pipes = bare.count(","), bare.count(";"), bare.count("|")
    if len(tokens) == 1 and len(bare) >= 24 and not commas and not semis and not bare.strip("|").count("|"):
        return 6
    if "\t" in bare or pipes >= 2:
        return 1
    if (commas or semis) and len(tokens) <= 1 + bare.count(", ") and len(bare) > 3 and bare[-1] not in ",;.":
        return 2
    if _BULLET.match(line):
        return 4
    return 3 if "  " in bare and _ALIGNED.search(bare) else 0


def _sense(bare: str, inner: int, symbols: int, lowered: list[str], common: int) -> int:
    """0 symbols, 1 broken encoding, 2 repetition, 3 unspeakable letters, 4 function words, 5 other."""
    n = len(lowered)
    if inner and symbols > 0.4 * inner:
        return 0
    if not bare.isascii() and _BROKEN.search(bare) or not bare.isprintable() and _CONTROL.search(bare):
        return 1
    if n >= 3 and len(set(lowered)) <= max(1, n // 3):
        return 2
    if n and common * 8 >= n:
        return 4
    spoken = [w for w in lowered if len(w) > 2]
    if spoken and sum(1 for w in spoken if not _VOWEL.search(w)) * 2 > len(spoken):
        return 3
    return 5


def line_shape(line: str) -> LineShape:
    """The statistics of one line that is not blank."""
    bare = line.strip()
    tokens = bare.split()
    inner = sum(map(len, tokens))
    lowered = [w.lower() for w in _WORD.findall(bare)]
    letters = sum(map(len, lowered))
    digits = sum(map(bare.count, _DIGITS))
    symbols = max(0, inner - letters - digits)
    common = sum(map(COMMON_WORDS.__contains__, lowered))
    n = len(lowered)
    length = 0 if n <= 4 else 1 if n <= 6 else 2 if n <= 12 else 3
    numbers = 0
    if digits:
        cells = [t for t in _SPLIT.split(bare) if t]
        figures = sum(map(bool, map(_NUMBER.match, cells)))
        numbers = 0 if not figures else 1 if figures * 3 < len(cells) else 2
    end = 1 if bare.endswith(_ENDS[:3]) else 2 if bare.endswith((",", ":")) else 0
    symbol = 0
    for value, (_, size) in zip((_layout(line, bare, tokens), length, _sense(bare, inner, symbols, lowered, common), numbers, end), _FIELDS, strict=True):
        symbol = symbol * size + value
    return LineShape(n, letters, symbols, common, inner, symbol)


def plain_label(symbol: int) -> int:
    """The kind of a line whose shape is beyond doubt (index in KINDS), -1 otherwise."""
    fields = []
    for _, size in reversed(_FIELDS):
        fields.append(symbol % size)
        symbol //= size
    end, numbers, sense, length, layout = fields
    if layout in (5, 6) or sense in (0, 1, 2, 3):
        return 3 if layout != 1 or sense in (1, 3) else -1
    if layout in (1, 2, 3):
        return 2 if numbers or layout != 3 else -1
    if layout == 4:
        return 1 if length <= 1 else -1
    if end and length == 0 or sense == 4 and length >= 2:
        return 0  # greetings, the rests of wrapped sentences, sentences
    if sense == 5 and length == 0:
        return 1
    return -1


class LineModel(NamedTuple):
    """Log probabilities: start (4), move (4 x 4), emit (4 x N_SYMBOLS)."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def fit(symbols: list[list[int]], rounds: int = ROUNDS) -> LineModel:
    """The model of a sample's mails (symbols of their lines).

    At first only lines of certain shape are counted; in each round the model labels the
    lines in doubt and is counted anew with them.  Certain labels never change, so the kinds keep
    their meaning.
    """
    certain = [np.array([plain_label(s) for s in line_symbols], np.int8) for line_symbols in symbols]
    model = _counted(symbols, certain)
    for _ in range(rounds):
        guessed = label_lines(symbols, model)
        model = _counted(symbols, [np.where(sure >= 0, sure, guess) for sure, guess in zip(certain, guessed, strict=True)])
    return model


def _counted(symbols: list[list[int]], labels: list[np.ndarray]) -> LineModel:
    """Frequencies with smoothing: emissions are products of the fields' frequencies; lines without a label (-1) are left out, neighbours of them too for the moves."""
    sizes = [n for _, n in _FIELDS]
    tables = [np.full((4, n), 0.5) for n in sizes]
    move = np.full((4, 4), 1.0) + np.eye(4) * 20
    start = np.ones(4)
    for line_symbols, own in zip(symbols, labels, strict=True):
        if not len(own):
            continue
        known = own >= 0
        rest, kinds = np.array(line_symbols)[known], own[known]
        for values, size in zip(reversed(tables), reversed(sizes), strict=True):
            np.add.at(values, (kinds, rest % size), 1)
            rest = rest // size
        if known[0]:
            start[own[0]] += 1
        both = known[1:] & known[:-1]
        np.add.at(move, (own[:-1][both], own[1:][both]), 1)
    emit = np.zeros((4, 1))
    for values in tables:
        share = np.log(values / values.sum(1, keepdims=True))
        emit = (emit[:, :, None] + share[:, None, :]).reshape(4, -1)
    return LineModel(np.log(start / start.sum()), np.log(move / move.sum(1, keepdims=True)), emit)


def label_lines(symbols: list[list[int]], model: LineModel) -> list[np.ndarray]:
    """The most likely labels of each mail's lines, all mails of a batch in step."""
    order = sorted(range(len(symbols)), key=lambda i: -len(symbols[i]))
    lengths = np.array([len(symbols[i]) for i in order])
    longest = int(lengths[0]) if len(lengths) else 0
    labels = [np.empty(len(s), np.int8) for s in symbols]
    if not longest:
        return labels
    alive = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest)]  # mails with more than t lines
    grid = [np.array([symbols[i][t] for i in order[: alive[t]]]) for t in range(longest)]
    score = model.start[None, :] + model.emit[:, grid[0]].T
    back: list[np.ndarray] = []
    final = score.copy()
    for t in range(1, longest):
        k = alive[t]
        ways = score[:k, :, None] + model.move[None, :, :]
        back.append(ways.argmax(1).astype(np.int8))
        score = ways.max(1) + model.emit[:, grid[t]].T
        final[:k] = score
    state = final.argmax(1).astype(np.int8)
    for t in range(longest - 1, -1, -1):
        k = alive[t]
        for row in range(k):
            labels[order[row]][t] = state[row]
        if t:
            state[:k] = back[t - 1][np.arange(k), state[:k]]
    return labels


def weigh(labels: np.ndarray, sizes: list[int], mainly: float = 0.5) -> tuple[list[float | None], str]:
    """The labels' shares of the lines, and the kind.

    The kind is the label whose mean of its share of lines and its share of
    characters is above ``mainly``, else prose: a few list lines do not outweigh
    paragraphs that stand on one line each.
    """
    if not len(labels):
        return [None] * 4, KINDS[0]
    lines = np.bincount(labels, minlength=4) / len(labels)
    signs = np.bincount(labels, weights=sizes, minlength=4) / max(1, sum(sizes))
    both = (lines + signs) / 2
    best = int(both.argmax())
    return lines.tolist(), KINDS[best] if both[best] > mainly else KINDS[0]


_SCHEMA = (
    "doc_id {kind}, n_words bigint, mean_word_length double, symbol_ratio double, share_lines_ending_punct double, share_common_words double, "
    "n_lines bigint, share_prose double, share_list double, share_table double, share_junk double, kind string"
)


def own_texts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ``lines`` of the own text that are not blank, and ``tail``, the shingles at its end; one pass over all mails."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                lines = [[x for x in own_lines(t) if x.strip()] for t in batch.column(1).to_pylist()]
                tails = [sorted(set(_tail(x)[0]) - {0}) for x in lines]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.list_(pa.string())), pa.array(tails, pa.list_(pa.int64()))], names=["doc_id", "lines", "tail"])

    kind = documents.schema[doc_id].dataType.simpleString()
    return spread(documents.select(doc_id, text)).mapInArrow(read, f"doc_id {kind}, lines array<string>, tail array<bigint>")


def frequent_shingles(own: DataFrame, share: float = BOILERPLATE_SHARE, least: int = BOILERPLATE_MAILS) -> frozenset[int]:
    """The shingles at the end of at least a share of all mails; TAIL_WORDS / share of them at most."""
    needed = max(least, share * own.count())
    counted = own.select(F.explode("tail").alias("shingle")).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    return frozenset(r[0] for r in counted.where(F.col("n") >= needed).select("shingle").collect())


def fit_on(own: DataFrame, frequent: frozenset[int], sample_docs: int = SAMPLE_DOCS) -> LineModel:
    """The model, fitted on the ``sample_docs`` mails of lowest id hash (all mails if there are fewer); ``own`` comes from :func:`own_texts`."""

    def shapes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[line_shape(x).symbol for x in without_boilerplate(lines, frequent)] for lines in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], names=["symbols"])

    hashed = own.select("lines", F.xxhash64("doc_id").alias("__h"))
    # the last hash of the sample is found from hashes alone, so texts beyond it are never sorted
    last = hashed.select("__h").orderBy("__h").limit(sample_docs).agg(F.max("__h")).scalar()
    chosen = hashed.where(F.col("__h") <= last).orderBy("__h").limit(sample_docs).select("lines")
    return fit([row[0] for row in spread(chosen).mapInArrow(shapes, "symbols array<int>").collect()])


def quality(documents: DataFrame, model: LineModel | None = None, doc_id: str = "doc_id", text: str = "text", mainly: float = 0.5) -> DataFrame:
    """One row per mail: figures on its own text, the shares of its line labels and its kind.

    ``kind`` is decided by :func:`weigh`.  A mail without own text has zero counts, null ratios and
    kind ``prose``.  All texts are read in full.
    """
    own = cut(own_texts(documents, doc_id, text))
    frequent = frequent_shingles(own)
    if model is None:
        model = fit_on(own, frequent)
    shared = documents.sparkSession.sparkContext.broadcast((tuple(model), frequent))  # plain arrays: workers need no class to read them
    names = ["doc_id", *re.findall(r", (\w+) ", _SCHEMA)]

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows: list[tuple] = []
                symbols: list[list[int]] = []
                sizes: list[list[int]] = []
                for said in batch.column(1).to_pylist():
                    lines = without_boilerplate(said, shared.value[1])
                    shapes = [line_shape(x) for x in lines]
                    symbols.append([s.symbol for s in shapes])
                    words, letters = sum(s.words for s in shapes), sum(s.letters for s in shapes)
                    signs = sum(s.symbols for s in shapes)
                    ended = sum(x.rstrip().endswith(_ENDS[:3]) for x in lines)
                    sizes.append([s.size for s in shapes])
                    inner = sum(sizes[-1])
                    rows.append((
                        words, letters / words if words else None, signs / inner if inner else None, ended / len(lines) if lines else None,
                        sum(s.common for s in shapes) / words if words else None, len(lines),
                    ))
                out: list[tuple] = []
                for row, labels, weights in zip(rows, label_lines(symbols, LineModel(*shared.value[0])), sizes, strict=True):
                    shares, kind = weigh(labels, weights, mainly)
                    out.append((*row, *shares, kind))
                columns = [pa.array(c) for c in zip(*out, strict=True)]
                types = [pa.int64(), *[pa.float64()] * 4, pa.int64(), *[pa.float64()] * 4, pa.string()]
                yield pa.RecordBatch.from_arrays([batch.column(0), *[c.cast(t) for c, t in zip(columns, types, strict=True)]], names=names)

    kind = documents.schema[doc_id].dataType.simpleString()
    return own.select("doc_id", "lines").mapInArrow(measure, _SCHEMA.format(kind=kind)).withColumnRenamed("doc_id", doc_id)
