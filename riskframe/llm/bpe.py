"""Byte-level BPE vocabularies of ``tokenizers`` files, run by ``tiktoken``, which encodes some four times as fast.

Both apply the merge of least rank first, but ``tokenizers`` merges the stated
pair while ``tiktoken`` merges any two neighbours that make up a token.  This
is the same if ids ascend with the merges and each token, spelled alone, is
built up by the merges to itself: neighbours that make up a token then always
are its stated pair.  ``ranks`` checks that of a file, and gives None if it
isn't so.  A word's end mark is written as a zero byte after the word; its
merges with single bytes have the least ids, so it is taken up first.
"""

from __future__ import annotations

import json

END = b"\0"


def byte_of() -> dict[str, int]:
    """The character that stands for each byte in such files: itself if it's visible, else the next free one from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _spelled(token: str, suffix: str) -> list[str]:
    if suffix and token.endswith(suffix) and len(token) > len(suffix):
        token = token[:-len(suffix)]
        return [*token[:-1], token[-1] + suffix]
    return list(token)


def _merged(parts: list[str], rank: dict[tuple[str, str], int]) -> list[str]:
    while len(parts) > 1:
        best = min(zip(parts, parts[1:]), key=lambda pair: rank.get(pair, len(rank)))
        if best not in rank:
            break
        out, i = [], 0
        while i < len(parts):
            both = tuple(parts[i:i + 2]) == best
            out.append("".join(best) if both else parts[i])
            i += 1 + both
        parts = out
    return parts


def ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """(id by bytes of each token, id of each special string); None if ids could differ."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, suffix = file["model"], file["model"].get("end_of_word_suffix") or ""
    special = {t["content"]: t["id"] for t in file["added_tokens"]}
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return None
    vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in pairs]
    if min(made, default=0) < len(vocabulary) - len(pairs) or any(a >= b for a, b in zip(made, made[1:])):
        return None
    rank = {p: i for i, p in enumerate(pairs)}
    codes, out = byte_of(), {}
    for token, i in vocabulary.items():
        parts = _spelled(token, suffix)
        if _merged(parts, rank) != [token]:
            return None
        word = parts[-1].endswith(suffix) and len(parts[-1]) > 1 if suffix else False
        plain = token[:-len(suffix)] if word else token
        out[bytes(codes[c] for c in plain) + (END if word else b"")] = i
    return (out, special) if len(out) == len(vocabulary) else None


def encoding(found: tuple[dict[bytes, int], dict[str, int]], pattern: str, special: bool = True):
    """A ``tiktoken`` encoding of what ``ranks`` gives; ``pattern`` matches the words."""
    import tiktoken
    return tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=found[0], special_tokens=found[1] if special else {})
