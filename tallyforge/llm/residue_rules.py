"""Which pieces of documents show by their form that they are no content: the trusted labels of problem 8.

A piece of a document (its message or a line of it, its author line, what stands for its diff, or a text without
any layout) is judged as a whole. Trusted are forms, not sentences: unfilled slots, words of filler text, and the
dress of a page or message that failed (envelope, markup, menu, incident number). The sentence in such a dress is
cut out, so that its copies in other dress, or in none, can be found as near-duplicates.
"""

from __future__ import annotations

import json
import re
from http import HTTPStatus

# --- fixed values -----------------------------------------------------------------------------------------------
# Names of the slots of commit templates.
SLOTS = (
    "author", "body", "branch", "change", "change_type", "component", "date", "description", "email", "issue", "message", "module", "name", "project",
    "reason", "reviewer", "scope", "short_desc", "subject", "summary", "text", "ticket", "title", "type", "version",
)
# Words that ask to fill a slot, in the languages of the messages.
ASKING = (
    "your", "insert", "enter", "add a", "add an", "add the", "describe", "fill in", "hier", "bitte", "eintragen", "einfügen", "escriba", "insertar",
    "inserte", "introduzca", "aquí", "votre", "insérer", "saisir", "ici", "wstaw", "wpisz", "tutaj",
)
# Words of a template around its slots.
SCAFFOLD = (
    "add", "author", "authored", "branch", "trunk", "develop", "bug", "bump", "by", "change", "chore", "close", "closes", "co", "date", "deps", "docs", "feat", "feature", "fix",
    "fixes", "for", "from", "in", "into", "issue", "main", "master", "merge", "merged", "of", "on", "patch", "pull", "reason", "ref", "refactor", "refs", "release", "remove",
    "request", "reviewed", "scope", "signed", "off", "subject", "summary", "tag", "task", "test", "ticket", "title", "to", "type", "update", "version", "with",
)
# Latin words of filler text.
LATIN = (
    "adipiscing", "aliqua", "aliquam", "amet", "congue", "consectetur", "cursus", "do", "dolor", "dolore", "eiusmod", "elit", "enim", "et", "fermen",
    "fermentum", "incididunt", "ipsum", "justo", "labore", "ligula", "lorem", "magna", "magnis", "mauris", "minim", "neque", "nunc", "porta", "pretium",
    "quis", "quisque", "rhoncus", "sapien", "sed", "semper", "sit", "tempor", "tempora", "tortis", "tortor", "ultra", "ultrices", "ut", "varia", "varius",
    "velit", "veniam", "vitae",
)
# Runs of neighbouring keys.
KEYS = ("asd", "asdf", "asdfg", "asdfgh", "fdsa", "ghjk", "hjkl", "jkl", "qwer", "qwerty", "qwertz", "sdf", "sdfsdf", "yxcv", "zxcv")
# --- end of fixed values ----------------------------------------------------------------------------------------

_SLOT = r"(?:(?:pr|change|commit|issue|mr)[._ ]?)?(?:" + "|".join(s.replace("_", "[_ ]?") for s in SLOTS) + ")"
_ASK = r"(?=[^\[\]<>«»]*\b(?:" + "|".join(ASKING) + r")\b)[^\[\]<>«»@/\"=]{3,}"
PLACEHOLDER = re.compile(
    r"\{\{\s*[\w.]+\s*\}\}|\{%\s*[\w.]+\s*%\}|<%=?\s*[\w.]+\s*%>|\$\{[\w.]+\}|\$\[[\w.]+\]|#\{[\w.]+\}|%\([\w.]+\)s|@@\w+?@@|\b__[A-Za-z]\w*?__\b"
    rf"|%{_SLOT}%|\[\[\s*[\w.]+\s*\]\]|\{{{_SLOT}\}}|<{_SLOT}>|\[{_SLOT}\]|«{_SLOT}»|\[{_ASK}\]|<{_ASK}>|«{_ASK}»",
    re.IGNORECASE,
)
_WORD = re.compile(r"[^\W\d_]+")
_AT_END = re.compile("\0[\\s.,;:)\\]>'\"`]*$")
_AT_START = re.compile("^\\s*(?:\\[\0\\]|\0\\s*:|\\w+\\(\0\\)!?:)")
_SCAFFOLD, _LATIN, _KEYS = frozenset(SCAFFOLD), frozenset(LATIN), frozenset(KEYS)


def is_placeholder(line: str) -> bool:
    """Is the line a template whose slots are unfilled: slots and scaffolding only, or a real text with a slot tacked on?"""
    cut, n = PLACEHOLDER.subn("\0", line)
    if not n:
        return False
    if _AT_START.search(cut) or _AT_END.search(cut):
        return True
    return all(w.lower() in _SCAFFOLD for w in _WORD.findall(cut))



_SPACE = re.compile(r"\s+")
_TAG = re.compile(r"<title>[^<]*</title>|</?[a-z][^<>]*>", re.IGNORECASE)
#: Markup around a whole piece, and the label of what is in it.
_MARKUP = (
    (re.compile(r"(?:<!doctype[^<>]*>\s*)?<html\b.*</html>", re.IGNORECASE | re.DOTALL), "error"),
    (re.compile(r"<noscript\b[^<>]*>.*</noscript>", re.IGNORECASE | re.DOTALL), "notice"),
    (re.compile(r"<(div|p|section|span)\b[^<>]*\bclass=[\"'][^\"'<>]*(?:warn|alert|error|notice)[^<>]*>.*</\1>", re.IGNORECASE | re.DOTALL), "notice"),
)
_ENCLOSED = re.compile(r"<[a-z][^<>]*>.*</[a-z][^<>]*>", re.IGNORECASE | re.DOTALL)
_FATAL = re.compile(r"^(?:fatal|error|panic): (.*) \(code \d+\)$")
_STATUS = re.compile(r"^(?:error:? )?[45]\d\d\b[ :.-]*")
_LOADING = re.compile(r"^loading\s*(?:\.\.\.|…)\s*")
_PICKED = re.compile(r"\(cherry picked from commit [0-9a-f]+\)$")
#: What tells notices from other messages.
_SCRIPT = re.compile(r"\b(?:java ?script|js|s[ck]ript\w*)\b")
#: Times a sentence must stand alone, one after the other, to be filler.
REPEATS = 3
#: Phrases of failed requests that every server may send; those of one word are too common.
PHRASES = frozenset(s.phrase.lower() for s in HTTPStatus if s >= 400 and " " in s.phrase)


def _backwards(*words: str) -> str:
    return "|".join(w[::-1] for w in words)


_ITEM = f"(?:{_backwards('home', 'reload', 'help', 'sign in', 'log in', 'back', 'contact', 'about', 'search')})"
_MENU, _OPERATOR = rf"{_ITEM}(?: \| {_ITEM})+", _backwards("go back to the start page or contact the operator")
#: A tail read from its end: so a text of any length is read once, however many tails or beginnings of one it has.
_TAIL = re.compile(
    rf"(?:\.?[\w.-]+ {_backwards('node')} ,[0-9a-f]+ {_backwards('incident')}|(?:\.? \| )?{_MENU}|\.?[0-9a-f]+ :?{_backwards('reference')}|\.?{_OPERATOR})[\s.]*"
)
_FURNITURE = re.compile(rf"[\s.]*(?:{_MENU}|{_OPERATOR})")


def _without_tails(s: str) -> str:
    """``s`` without the tails of a page, unless it is nothing else; ``s``: stripped, white space collapsed."""
    back, at = s[::-1], 0
    while (m := _TAIL.match(back, at)) and m.end() < len(back):
        at = m.end()
    return s[: len(s) - at]


def _once(s: str) -> tuple[str, int]:
    """What ``s`` repeats, and how often; ``s``: stripped, white space collapsed."""
    if not s:
        return s, 1
    t = s + " "
    at = (t + t).find(t, 1)
    if at < len(t):
        return s[: at - 1], len(t) // at
    parts = [p.strip(" .") for p in re.split(r"(?<=\.) ", s) if p.strip(" .")]
    return (parts[0], len(parts)) if len(parts) > 1 and len(set(parts)) == 1 else (s, 1)


def undress(piece: str) -> tuple[str, str | None]:
    """The sentence of a piece without the dress of a page or message, in lower case, and the label that the dress tells (or None).

    A status number or "Loading..." before a sentence is dress that real messages may have as well: it is cut off, but tells nothing.
    """
    s, told = piece.strip(), None
    if s.startswith("{") and s.endswith("}"):
        try:
            got = json.loads(s)
        except (ValueError, RecursionError):
            got = None
        if isinstance(got, dict) and isinstance(got.get("message"), str) and {"status", "error", "code"} & set(got):
            s, told = got["message"], "error"
    elif s.startswith("<") and s.endswith(">") and _ENCLOSED.fullmatch(s):
        told = next((kind for markup, kind in _MARKUP if markup.fullmatch(s)), None)
        s = _TAG.sub(" ", s)
    s = _SPACE.sub(" ", s).strip().lower()
    if _FURNITURE.fullmatch(s[::-1]):
        return s.strip(" .!"), "error"
    # The same sentence twice or more is that sentence, with its dress or without.
    s, first = _once(s)
    if m := _FATAL.match(s):
        s, told = m[1], told or "error"
    s = _LOADING.sub("", s)
    whole = len(s)
    s = _without_tails(s)
    told = told or ("error" if len(s) < whole else None)
    s, second = _once(_STATUS.sub("", s).strip(" .!"))
    return s.strip(" .!"), told or ("filler" if first * second >= REPEATS else None)


def is_filler(s: str) -> bool:
    """``s``: lower case, white space collapsed."""
    words = s.split()
    kinds = len(set(words))
    if len(words) >= 4 and kinds <= 2 and all(words[i] == words[i % kinds] for i in range(len(words))):
        return True
    bare = _WORD.findall(s)
    if len(bare) < 4 or len(bare) < 0.8 * len(words):
        return False
    if sum(w in _LATIN for w in bare) >= 0.75 * len(bare):
        return True
    return all(w in _KEYS for w in bare)


def judge(piece: str | None) -> tuple[str | None, str, bool]:
    """Label (placeholder, filler, error or notice; None if the form tells nothing), the text to compare, and whether only equal texts are its copies.

    Null and blank pieces have no label and no text. A real text with an unfilled slot tacked on is like itself only:
    a text without the slot would be much like it and yet be content.
    """
    if not piece or not piece.strip():
        return None, "", True
    stripped = piece.rstrip()
    if m := _PICKED.search(stripped):
        piece = stripped[: m.start()].rstrip()
    flat = _SPACE.sub(" ", piece).strip().lower()
    # One line or several: a template may have a slot on every line.
    lines = [x for x in piece.split("\n") if x.strip()]
    if lines and all(map(is_placeholder, lines)):
        return "placeholder", flat, True
    if is_filler(flat):
        # A sentence that stands there again and again may also stand alone.
        once, times = _once(flat)
        return "filler", once.strip(" .!") if times >= REPEATS and once.endswith((".", "!")) and " " in once else flat, False
    s, told = undress(piece)
    if not s:
        return None, flat, False
    found = told or ("error" if s in PHRASES else None)
    return ("notice" if found == "error" and _SCRIPT.search(s) else found), s, False


def label(piece: str | None) -> str | None:
    """The label that the piece's form tells, if any."""
    return judge(piece)[0]
