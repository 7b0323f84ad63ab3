"""The parts of a commit's text: message, author and what stands for the diff, in four layouts."""

from __future__ import annotations

import re
from collections.abc import Iterator

_HEAD = re.compile(r"(?P<git_log>commit [0-9a-f]{7,40}\b)|(?P<patch_mail>From [0-9a-f]{7,40}\b)|(?P<svn_bridge>r\d+ \|)|(?P<forge_api>title:)")
_TRAILING = re.compile(r"[ \t]+\n")
_HEADERS = ("Author:", "AuthorDate:", "Commit:", "CommitDate:", "Date:", "Merge:")
_PATCH = re.compile(r"^\[PATCH[^\]]*\]\s*")
_DIFF = re.compile(r"^(?:diff --git |Index: |--- a/|Binary files )", re.MULTILINE)
_SIGNATURE = re.compile(r"\n?-- ?\n[\d.]+\s*\Z")
_PICKED = re.compile(r"\s*\(cherry picked from commit [0-9a-f]+\)\s*\Z")
_RULE = re.compile(r"\n?-{40,}\s*\Z")


def _header(text: str, name: str) -> tuple[str | None, str]:
    """Value of the header line ``name`` if the text starts with it, blank lines aside, and the text after it."""
    if not text.lstrip("\n").startswith(name):
        return None, text
    line, _, rest = text.lstrip("\n").partition("\n")
    return line[len(name) :].strip(), rest


def parts(text: str) -> dict[str, str | None]:
    """message, author and other (what stands where the diff should, if that is no diff), or whole for a text without layout."""
    text = _TRAILING.sub("\n", text.replace("\r\n", "\n").replace("\r", "\n")).lstrip("﻿\n")
    text = _PICKED.sub("\n", text)
    head = _HEAD.match(text)
    kind = head.lastgroup if head else None
    if kind is None:
        return {"whole": text}
    first, _, rest = text.partition("\n")
    author, found = None, _DIFF.search(rest)
    before, diff = (rest[: found.start()], None) if found else (rest, "")
    if kind == "git_log":
        while before.lstrip("\n").startswith(_HEADERS):
            line, _, before = before.lstrip("\n").partition("\n")
            if line.startswith("Author:"):
                author = line[7:].strip()
        lines = before.split("\n")
        n = 0
        while n < len(lines) and (lines[n].startswith("    ") or not lines[n].strip()):
            n += 1
        message, other = "\n".join(x[4:] if x.startswith("    ") else x for x in lines[: None if found else n]), "" if found else "\n".join(lines[n:])
    elif kind == "patch_mail":
        author, before = _header(before, "From:")
        subject, before = _header(before, "Subject:")
        body, line, other = before.partition("---\n") if before.startswith("---\n") else before.partition("\n---\n")
        message = _PATCH.sub("", subject or "") + "\n" + body
        other = _SIGNATURE.sub("", other)
    elif kind == "svn_bridge":
        author = (first.split("|") + [""])[1].strip()
        # Without a diff, message and what stands for it are told apart by the blank lines only.
        message, other = _RULE.sub("", before), ""
    else:
        author, before = _header(before, "author:")
        _, before = _header(before, "repo:")
        body, fence, other = before.partition("```diff\n")
        message = first[6:].strip() + "\n" + body
        other = other.rstrip().removesuffix("```")
    return {"message": message, "author": author, "other": other if diff is not None and other.strip() else None}


def pieces(text: str | None) -> Iterator[tuple[str, str]]:
    """(part, piece): what a document may hold instead of content. The message also in paragraphs and lines."""
    if not text or not text.strip():
        return
    got = parts(text)
    if "whole" in got:
        yield "whole", got["whole"].strip()
        return
    if got["author"]:
        yield "author", got["author"]
    if got["other"]:
        yield "diff", got["other"].strip()
    message = got["message"].strip()
    seen = set()
    for piece in [message, *re.split(r"\n\s*\n", message), *message.split("\n")]:
        piece = piece.strip()
        if piece and piece not in seen:
            seen.add(piece)
            yield "message", piece
