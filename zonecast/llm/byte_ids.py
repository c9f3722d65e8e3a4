"""Ids of whole texts by a byte-level BPE file, word by word.

The byte-level pre-tokenizer never joins a character that is not white space with white
space after it, so a text may be cut there and every chunk encoded alone. Chunks repeat
across a corpus; a worker encodes each once and remembers it, in two generations of a
bounded memo. Texts for which the cut is not certain (a special token inside, characters
that only some engines call white space, another pre-tokenizer) are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

#: Remembered chunks of a worker; when so many are young, the old ones go.
MEMO_SIZE = 300_000
#: White space to Python or to older Unicode tables only: texts with these are not cut.
UNSURE = re.compile("[\x1c-\x1f\x85᠎]")
#: White space besides blanks and line feeds, and what is unsure.
ODD = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0 ᠎ -     　]")
CHUNK = re.compile(r"\s*\S+|\s+")
#: ASCII signs but the apostrophe, which may go with letters. A word of Latin letters, or a
#: number, and a run of signs after it are pre-tokens of their own.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_WORD = r"(?:[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+|[0-9]+)"
LATIN = re.compile(_WORD)
SIMPLE = re.compile(rf"([ \n]*)({_WORD})([{re.escape(SIGNS)}]*)")
FORMATS = [f"<{n}I" for n in range(17)]


def byte_signs() -> dict[int, str]:
    """The character that a byte-level vocabulary writes for each byte: printable Latin-1
    ones stand for themselves, the others are numbered from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(others)}


class ByteIds:
    """``of(texts)``: ids of every text as packed little-endian unsigned 32-bit integers,
    as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them. With
    ``special_as_text`` the strings of special tokens are ordinary text."""

    def __init__(self, tokenizer_file: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = self.whole = Tokenizer.from_file(tokenizer_file)
        if special_as_text:
            self.whole = Tokenizer.from_file(tokenizer_file)
            self.whole.encode_special_tokens = True
        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        pre, kind = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        added = self.tok.get_added_tokens_decoder()
        self.added = [t.content for t in added.values()]
        # one special token parts the chunks of a joined call, which costs less than a call each
        marks = [(i, t.content) for i, t in sorted(added.items())
                 if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.mark_id, self.mark = marks[0] if marks else (None, None)
        self.can_cut = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and spec.get("normalizer") is None and bool(marks))
        self.simple = self.can_cut and kind.get("type", "BPE") == "BPE" and not any(
            kind.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        self.model, self.signs = self.tok.model, byte_signs()
        self.runs: dict[str, bytes] = {}      # ids of runs of signs and white space
        self.memo: dict[str, bytes] = {}      # ids of a blank and the word
        self.old: dict[str, bytes] = {}

    def encode_whole(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _pretoken(self, s: str) -> bytes:
        """Ids of one pre-token by the model itself."""
        return self._ids(s.encode().decode("latin-1").translate(self.signs))

    def _ids(self, signs: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(signs)]
        return struct.pack(FORMATS[len(ids)] if len(ids) < len(FORMATS) else f"<{len(ids)}I", *ids)

    def _run(self, s: str) -> bytes:
        got = self.runs.get(s)
        if got is None:
            got = self._pretoken(s)
            if len(s) <= 8 and len(self.runs) < MEMO_SIZE:
                self.runs[s] = got
        return got

    def _learn(self, words: list[str]) -> None:
        """Take words without white space into the memo, each with a blank before it."""
        memo, old, rest, blank = self.memo, self.old, [], self.signs[32]
        for w in words:
            core = w.rstrip(SIGNS)
            ascii_word = core.isascii() and core.isalpha()
            if not (self.simple and core and (ascii_word or LATIN.fullmatch(core))):
                rest.append(w)
                continue
            got = memo.get(core)
            if got is None:
                got = old.get(core)
                if got is None:     # ASCII letters stand for themselves
                    got = self._ids(blank + core) if ascii_word else self._pretoken(" " + core)
                memo[core] = got
            if len(core) < len(w):
                memo[w] = got + self._run(w[len(core):])
        memo.update(zip(rest, self.encode_chunks([" " + w for w in rest])))

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, each as if it stood alone: plain words by the model itself, the
        rest by the whole tokenizer."""
        if not self.can_cut:
            return [self.encode_whole(c) for c in chunks]
        out, rest, run_of, pretoken = [b""] * len(chunks), [], self._run, self._pretoken
        for i, c in enumerate(chunks):
            m = SIMPLE.fullmatch(c) if self.simple else None
            if m is not None:
                space, word, signs = m.groups()
                if space == " ":
                    got = pretoken(" " + word)
                elif not space:
                    got = pretoken(word)
                else:       # all white space but the last character is one run; a last blank goes with the word
                    got = (run_of(space[:-1]) if len(space) > 1 else b"") + (
                        pretoken(" " + word) if space[-1] == " " else run_of(space[-1]) + pretoken(word))
                out[i] = got + run_of(signs) if signs else got
            elif any(a in c for a in self.added):
                out[i] = self.encode_whole(c)
            else:
                rest.append(i)
        for k in range(0, len(rest), 2000):
            run = rest[k:k + 2000]
            ids = np.array(self.tok.encode(self.mark.join([chunks[i] for i in run]), add_special_tokens=False).ids, "<u4")
            cut = 4 * np.flatnonzero(ids == self.mark_id)
            raw = ids.tobytes()
            for i, a, b in zip(run, [0, *(cut + 4).tolist()], [*cut.tolist(), len(raw)]):
                out[i] = raw[a:b]
        return out

    def encode_cut(self, text: str) -> bytes:
        """A text by its chunks, wherever it may be cut."""
        if not self.can_cut or UNSURE.search(text) or any(a in text for a in self.added):
            return self.encode_whole(text)
        return b"".join(self.encode_chunks(CHUNK.findall(text)))

    def of(self, texts: list[str]) -> list[bytes]:
        # where blanks follow other characters only, a text is its first word and words that
        # each begin with a blank
        split = [t.split(" ") if self.can_cut and not ODD.search(t) and "  " not in t and "\n " not in t
                 and not any(a in t for a in self.added) else None for t in texts]
        memo, old, missing, held = self.memo, self.old, set(), []
        for s in split:
            if s is None:
                held.append((None, ()))
                continue
            got = list(map(memo.get, s))
            got[0] = self.encode_cut(s[0]) if s[0] else b""
            holes = [i for i, g in enumerate(got) if g is None]
            missing.update([s[i] for i in holes])
            held.append((got, holes))
        feeds, plain = [], []
        for w in missing:
            if w in old:
                memo[w] = old[w]
            else:
                (feeds if "\n" in w else plain).append(w)
        memo.update(zip(feeds, self._with_feeds(feeds)))
        self._learn(plain)
        out = []
        for t, s, (got, holes) in zip(texts, split, held):
            for i in holes:
                got[i] = memo[s[i]]
            out.append(self.encode_cut(t) if got is None else b"".join(got))
        if len(memo) > MEMO_SIZE:
            self.old, self.memo = memo, {}
        return out

    def _with_feeds(self, words: list[str]) -> list[bytes]:
        """Ids of a blank and each word, the words cut once more at line feeds."""
        parts = [CHUNK.findall(" " + w) for w in words]
        flat = iter(self.encode_chunks([c for p in parts for c in p]))
        return [b"".join([next(flat) for _ in p]) for p in parts]
