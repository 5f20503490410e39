"""Tokenizers of public vocabulary files inside tasks.

The driver reads a file and hands its bytes out; its size is the vocabulary's and does not
grow with the corpus.  A task builds its tokenizer when it begins and keeps nothing when it ends.
"""

from __future__ import annotations

import base64

import numpy as np
import regex
import tiktoken

#: Runs of white space from this length on are cut out before the pattern sees them: its
#: look-ahead would need a stack as deep as the run.
LONG_RUN = 50_000
#: The characters with the Unicode property White_Space.
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_RUNS = regex.compile(WHITE + "{%d,}" % LONG_RUN)


def contents(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class ByteBPE:
    """Byte-level BPE from ``base64 rank`` lines.  ``special`` strings inside texts become their
    ids; without any they are plain text."""

    def __init__(self, ranks: bytes, pattern: str, special: dict[str, int] | None = None):
        by_bytes = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.special = special or {}
        self.own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=by_bytes, special_tokens=self.special)
        self.size = max([*by_bytes.values(), *self.special.values()]) + 1
        self.pieces = [b""] * self.size
        for piece, i in by_bytes.items():
            self.pieces[i] = piece
        for string, i in self.special.items():
            self.pieces[i] = string.encode()
        self.pieces = np.array(self.pieces, object)

    def _short(self, text: str) -> list[int]:
        return self.own.encode(text, allowed_special="all") if self.special else self.own.encode_ordinary(text)

    def encode(self, text: str) -> np.ndarray:
        runs = list(_RUNS.finditer(text)) if len(text) >= LONG_RUN else []
        if not runs:
            return np.array(self._short(text), np.int64)
        ids: list[int] = []
        at = 0
        for run in runs:
            # before a word the run's last character is not the run's
            end = run.end() if run.end() == len(text) else run.end() - 1
            ids += self._short(text[at:run.start()])
            ids += self.own._encode_single_piece(text[run.start():end])
            at = end
        return np.array(ids + self._short(text[at:]), np.int64)

    def lengths(self) -> np.ndarray:
        return np.array([len(p) for p in self.pieces], np.int64)


class PieceBPE:
    """A sentencepiece model that leaves its text as it is but for the space that it adds, which
    the caller adds here.  U+2581 stands for a space, ``<0xHH>`` for a byte."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("this model rewrites its text, so its tokens have no place in it")
        rules.add_dummy_prefix = False
        self.own = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.size = self.own.get_piece_size()
        self.pieces, self.neighbours = [], set()
        for i in range(self.size):
            piece = self.own.id_to_piece(i)
            if self.own.is_byte(i):
                self.pieces.append(bytes([int(piece[3:5], 16)]))
                continue
            self.pieces.append(piece.replace("▁", " ").encode())
            self.neighbours.update(zip(piece, piece[1:]))
        self.pieces = np.array(self.pieces, object)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.own.encode(text) if text else [], np.int64)

    def lengths(self) -> np.ndarray:
        return np.array([len(p) for p in self.pieces], np.int64)

    def apart(self, before: str, after: str) -> bool:
        """No piece has these two characters side by side, so no token spans them."""
        return (before.replace(" ", "▁"), after.replace(" ", "▁")) not in self.neighbours


def join(pieces: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of tokens one behind the other; ``pieces`` are those of each id."""
    return b"".join(pieces[ids].tolist())
