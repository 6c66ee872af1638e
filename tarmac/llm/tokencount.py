"""Token counts of a unigram model, with the scores of shared prefixes computed once.

The distinct pre-tokens of a task make a trie. Its nodes carry the best score and its token count
of the path that leads to them; terminal nodes hand their count to the pre-token. The pre-tokens
are visited in sorted order, which is a walk over that trie from left to right: the nodes of the
current path stay on a stack, so each node of the trie is scored once and memory holds one path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tarmac.llm.common import append_columns
from tarmac.llm.pieces import MODEL, Vocabulary, load, pretokens, to_bytes

#: Terminal counts a task remembers; then it forgets them and starts anew with the same results.
REMEMBERED = 500_000


def terminal_counts(tokens, vocabulary: Vocabulary) -> dict[str, int]:
    """Tokens in the best segmentation of each pre-token; of equal scores the fewer tokens."""
    scores, longest, byte_score = vocabulary.scores, vocabulary.longest, vocabulary.byte_score
    counts: dict[str, int] = {}
    best, used = [0.0], [0]
    before = ""
    for token in sorted(tokens):
        shared, most = 0, min(len(before), len(token))
        while shared < most and before[shared] == token[shared]:
            shared += 1
        del best[shared + 1:], used[shared + 1:]
        for end in range(shared + 1, len(token) + 1):
            char = token[end - 1]
            if char in scores:
                top, n = best[end - 1] + scores[char], used[end - 1] + 1
            else:
                size = len(to_bytes(char))
                top, n = best[end - 1] + size * byte_score, used[end - 1] + size
            for start in range(end - 2, max(0, end - longest.get(char, 0)) - 1, -1):
                score = scores.get(token[start:end])
                if score is not None:
                    score += best[start]
                    if score > top or (score == top and used[start] + 1 < n):
                        top, n = score, used[start] + 1
            best.append(top)
            used.append(n)
        counts[token] = used[-1]
        before = token
    return counts


def count_tokens(docs: DataFrame, text: str = "text", tokens: str = "n_tokens",
                 parts: str = "n_pretokens", model: str = MODEL) -> DataFrame:
    """``docs`` with the tokens and pre-tokens of each text; 0 for a null or empty one.

    The vocabulary file is read once, on the driver, and sent to the tasks; its size does not
    depend on the data. Every row is counted by itself, so repeated rows get equal counts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(load(model))

    def counted(batches):
        known: dict[str, int] = {}
        for (texts,) in batches:
            split = [pretokens(t) if t else [] for t in texts]
            fresh = {p for parts in split for p in parts if p not in known}
            if len(known) + len(fresh) > REMEMBERED:
                known = {}
                fresh = {p for parts in split for p in parts}
            known.update(terminal_counts(fresh, sent.value))
            yield [(sum(map(known.__getitem__, p)), len(p)) for p in split]

    return append_columns(docs, [text], f"{tokens} long, {parts} long", counted)
