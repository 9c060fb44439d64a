"""Raw mail messages to the texts a mail program would show.

Pure Python, one call per message, no third-party imports: the callers run it
inside Arrow batches.  Everything is tolerant: a message that breaks a rule of
the format is read as far as it goes, never rejected.
"""

from __future__ import annotations

import base64
import binascii
import html
import re
from typing import NamedTuple


class Part(NamedTuple):
    """One leaf of a message: its kind, whether it is (in) an attachment, its decoded text, and the set of alternatives it belongs to (0 if none)."""

    kind: str  # "plain" or "html"
    attached: bool
    text: str
    choice: int = 0


_HEADER = re.compile(r"^(content-type|content-transfer-encoding|content-disposition)[ \t]*:[ \t]*(.*(?:\n[ \t]+.*)*)", re.I | re.M)
_PARAM = re.compile(r"(boundary|charset|name|filename)\s*=\s*(?:\"([^\"]*)\"|([^\s;]+))", re.I)
_BLANK = re.compile(r"\n[ \t]*\n")
_QP_SOFT = re.compile(r"=[ \t]*\n")
_QP_RUN = re.compile(r"(?:=[0-9A-Fa-f]{2})+")
_NOT_BASE64 = re.compile(r"[^A-Za-z0-9+/=]+")
_BASE64_RUN = re.compile(r"([^=]*)(=*)")
_BREAK = re.compile(r"<\s*(?:br|hr)\b[^>]*>", re.I)
_CELL = re.compile(r"<\s*/?\s*(?:td|th)\b[^>]*>", re.I)
_BLOCK = re.compile(r"<\s*/?\s*(?:p|div|tr|table|ul|ol|li|h[1-6]|blockquote|pre|body|html|head|title)\b[^>]*>", re.I)
_DROPPED = re.compile(r"<\s*(script|style)\b.*?<\s*/\s*\1\s*>|<!--.*?-->", re.I | re.S)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<![A-Za-z][^<>]*>")


def split_head(text: str) -> tuple[str, str]:
    """Header block and body.  A leading blank line means there are no headers."""
    if text.startswith("\n"):
        return "", text[1:]
    found = _BLANK.search(text)
    return (text, "") if found is None else (text[: found.start()], text[found.end() :])


def undo_quoted_printable(body: str, charset: str = "utf-8") -> str:
    """Quoted-printable text; bytes that are no valid text become U+FFFD."""
    joined = _QP_SOFT.sub("", body)
    if "=" not in joined:
        return joined
    return _QP_RUN.sub(lambda m: _bytes_to_text(bytes.fromhex(m[0].replace("=", "")), charset), joined)


#: Characters up to which a run that is no text when decoded is taken for plain words.
_SHORT_RUN = 40


def undo_base64(body: str, charset: str = "utf-8") -> str:
    """Base64 text, run by run: padding ends a run, and another may follow.

    Characters outside the alphabet are skipped, but a line that has blanks inside or
    is mostly made of others is no part of a run: it stays as it stands, like a
    short run that does not decode to text (a footer's single word).
    """
    out: list[str] = []
    letters: list[str] = []
    written: list[str] = []

    def close() -> None:
        if letters:
            out.append(_decoded("".join(letters), "\n".join(written), charset))
            letters.clear()
        written.clear()

    for line in body.split("\n"):
        bare = line.strip()
        kept = _NOT_BASE64.sub("", bare)
        if not bare:
            if out and not letters:
                out.append("\n")
        elif len(kept) * 10 < len(bare) * 9 or " " in bare or "\t" in bare:
            close()
            out.append(line + "\n")
        else:
            for run in _BASE64_RUN.finditer(kept):
                if run[1]:
                    letters.append(run[1])
                    written.append(run[0])
                if run[2]:
                    close()
    close()
    return "".join(out)


def _decoded(letters: str, written: str, charset: str) -> str:
    letters = letters[: len(letters) - (len(letters) % 4 == 1)]
    try:
        raw = base64.b64decode(letters + "=" * (-len(letters) % 4))
    except (binascii.Error, ValueError):
        return written + "\n"
    if len(letters) <= _SHORT_RUN:
        try:
            raw.decode(charset)
        except LookupError:
            pass
        except UnicodeDecodeError:
            return written + "\n"
    return _bytes_to_text(raw, charset)


def _bytes_to_text(raw: bytes, charset: str) -> str:
    try:
        return raw.decode(charset, "replace")
    except LookupError:
        return raw.decode("utf-8", "replace")


def html_to_text(markup: str) -> str:
    """Text of a HTML part: blocks and breaks end lines, table cells are parted by tabs."""
    if "<!--" in markup or "<s" in markup or "<S" in markup:
        markup = _DROPPED.sub("", markup)
    markup = _BREAK.sub("\n", markup.replace("<br>\n", "\n"))
    markup = _CELL.sub("\t", markup)
    markup = _BLOCK.sub("\n", markup)
    return html.unescape(_TAG.sub("", markup))


def parts(text: str | None) -> list[Part]:
    """All text parts and text attachments of a raw message in their order, decoded.

    Null or empty text has no parts.  A message without a usable Content-Type is
    one plain part.  Parts that are no text (images, binaries) are left out.
    """
    if not text:
        return []
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    found: list[Part] = []
    choices = 0
    # (head, body, whether inside an attachment, set of alternatives) of what is still to be opened
    waiting = [(*split_head(text), False, 0)]
    while waiting:
        head, body, inside, choice = waiting.pop()
        fields = {m[1].lower(): m[2] for m in reversed(list(_HEADER.finditer(head)))}
        said = fields.get("content-type", "text/plain")
        kind = said.split(";", 1)[0].strip().lower()
        params = {m[1].lower(): m[2] if m[2] is not None else m[3] for m in _PARAM.finditer(said)}
        placed = fields.get("content-disposition", "").lower()
        attached = inside or placed.startswith("attachment")
        if kind.startswith("multipart/") and params.get("boundary"):
            if kind == "multipart/alternative":
                choices += 1
                choice = choices
            waiting.extend((*part, attached, choice) for part in reversed(_sections(body, params["boundary"])))
        elif kind == "message/rfc822":
            waiting.append((*split_head(body), True, choice))
        elif kind.startswith(("text/", "multipart/")) or "/" not in kind:
            text_of = _undone(body, fields.get("content-transfer-encoding", "").strip().lower(), params.get("charset", "utf-8"))
            attached = attached or "name" in params or "filename" in params
            found.append(Part("html", attached, html_to_text(text_of), choice) if kind == "text/html" else Part("plain", attached, text_of, choice))
    return found


def _sections(body: str, boundary: str) -> list[tuple[str, str]]:
    """Head and body of each part between a boundary's lines."""
    inside = []
    for section in ("\n" + body).split("\n--" + boundary)[1:]:
        if section.startswith("--"):
            break
        # the rest of the boundary's own line is no content
        inside.append(split_head(section.split("\n", 1)[1] if "\n" in section else ""))
    return inside


def _undone(body: str, coding: str, charset: str) -> str:
    """A body without its transfer encoding."""
    if coding == "quoted-printable":
        return undo_quoted_printable(body, charset)
    return undo_base64(body, charset) if coding == "base64" else body


def inline_texts(text: str | None) -> list[str]:
    """The texts that a mail shows as its own body: all inline parts in order, one kind of each set of alternatives (plain, if it has any)."""
    shown = [p for p in parts(text) if not p.attached and p.text.strip()]
    plain = {p.choice for p in shown if p.kind == "plain" and p.choice}
    return [p.text for p in shown if not p.choice or p.kind == "plain" or p.choice not in plain]


#: Marks that mail programs put before quoted lines, nested in any mix.
QUOTE_MARK = re.compile(r"^[ \t]*(?:[>|:][ \t]?)+", re.M)


def without_quote_marks(text: str) -> str:
    """The text with the quote marks at the beginning of its lines removed."""
    return QUOTE_MARK.sub("", text)
