"""A SentencePiece vocabulary as a unigram model, and the pre-tokens of a text."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Default place of the vocabulary file; every operator takes another path as a parameter.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: The sign for a space. A fixed value of the format.
SPACE = "▁"
#: Pieces with a score below this are in the file but barred from use.
_BARRED = -1e8


class Vocabulary(NamedTuple):
    """Pieces with natural log-probabilities, and the 256 byte pieces for all else."""

    pieces: list[str]           # by id
    scores: dict[str, float]    # log-probability of each usable piece
    ids: dict[str, int]
    byte_ids: list[int]         # of the bytes 0 to 255
    byte_score: float
    longest: dict[str, int]     # length of the longest usable piece that ends with a character
    spelled: list[bytes]        # what each id stands for
    letters: np.ndarray         # the same, all bytes one after another
    begun: np.ndarray           # where those of each id begin, and the end


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file with byte fallback.

    The file ranks its pieces by usefulness but has no probabilities: the piece of rank r gets one
    in proportion to 1 / (r + 1), as words have in texts, and each byte that of the next rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    byte_ids = [i for i in range(n) if model.is_byte(i)]
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary has no byte pieces")
    usable = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i)
              or model.is_unknown(i) or model.is_unused(i) or model.get_score(i) < _BARRED)]
    usable.sort(key=lambda i: (-model.get_score(i), i))
    total = float(np.log((1 / np.arange(1, len(usable) + 2)).sum()))
    scores = {pieces[i]: -float(np.log(r + 1)) - total for r, i in enumerate(usable)}
    longest: dict[str, int] = {}
    for piece in scores:
        longest[piece[-1]] = max(len(piece), longest.get(piece[-1], 0))
    spelled = [piece.encode() for piece in pieces]
    for byte, i in enumerate(byte_ids):
        spelled[i] = bytes([byte])
    return Vocabulary(pieces, scores, {pieces[i]: i for i in usable}, byte_ids,
                      -float(np.log(len(usable) + 1)) - total, longest, spelled,
                      np.frombuffer(b"".join(spelled), np.uint8),
                      np.cumsum([0, *map(len, spelled)]))


def pretokens(text: str, sign: str = SPACE) -> list[str]:
    """The parts of a text that no piece crosses; none for an empty text.

    No piece holds a line feed, or a space sign after another character, so lattices part there. A
    space sign stands before the text and for each space of it. ``sign`` is what the parts have for it;
    with a plain space those of a Latin text stay short.
    """
    if not text:
        return []
    marked = " " + text.replace(SPACE, " ")
    bar = "\0" if "\0" not in text else next(c for c in map(chr, range(33, 0x110000)) if c not in marked + SPACE)
    marked = marked.replace(" ", bar + sign)
    if "\n" in marked:
        marked = marked.replace("\n", f"{bar}\n{bar}").replace(bar + bar, bar).removesuffix(bar)
    while sign + bar + sign in marked:  # signs in a row belong to what follows them
        marked = marked.replace(sign + bar + sign, sign + sign)
    return marked[1:].split(bar)


def to_bytes(char: str) -> bytes:
    return char.encode("utf-8", "surrogatepass")


def decode(ids, vocabulary: Vocabulary) -> str:
    """The text of a sequence of ids: the inverse of every segmentation of that text.

    A text with the space sign itself comes back with spaces in its place.
    """
    return _text(b"".join(map(vocabulary.spelled.__getitem__, ids)))


def decode_all(lists: list[np.ndarray], vocabulary: Vocabulary) -> list[str]:
    """``decode`` of many arrays of ids, spelled together."""
    ids = np.concatenate([np.zeros(0, np.int32), *lists])
    from_ = vocabulary.begun.take(ids)
    sizes = vocabulary.begun.take(ids + 1) - from_
    begun = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(begun[-1]) + np.repeat(from_ - begun[:-1], sizes)
    spelled = vocabulary.letters.take(at).tobytes()
    cuts = begun.take(np.cumsum([0, *map(len, lists)])).tolist()
    return [_text(spelled[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def _text(spelled: bytes) -> str:
    return spelled.decode("utf-8", "surrogatepass").replace(SPACE, " ")[1:]
