"""Token ids of whole texts, by a public byte-level vocabulary."""

from __future__ import annotations

import base64

import numpy as np


class Ids:
    """Callable: text to little-endian 32-bit ids.

    The vocabulary never joins characters across a space or line break between two words, so a text whose words are
    parted by single spaces or line breaks is encoded word by word, from a bounded memory of words. Words not held are
    encoded through the rank file of the same vocabulary, which is quicker; all other texts, and texts that contain an
    added token, go through ``tokenizers`` whole. Both ways give the ids of ``tokenizers`` (see the tests).
    """

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None, most_words: int = 400_000):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            held = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding("ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=held,
                                        special_tokens={}).encode_ordinary
        self.added = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        self.most_words = most_words

    def _word(self, word: str) -> bytes:
        # A word that begins a line carries its line break; any other had a space before it.
        ids = np.array(self.encode(word if word[0] == "\n" else " " + word), dtype="<u4").tobytes()
        if len(self.words) < self.most_words and len(word) < 40:
            self.words[word] = ids
        return ids

    def __call__(self, text: str) -> bytes:
        if " ".join(text.split()) != text.replace("\n", " ") or any(t in text for t in self.added) or not text:
            ids = self.whole.encode(text, add_special_tokens=False).ids
            return np.array(ids, dtype="<u4").tobytes()
        first, *rest = text.replace("\n", " \n").split(" ")
        get, word = self.words.get, self._word
        start = np.array(self.encode(first), dtype="<u4").tobytes()
        return start + b"".join([get(w) or word(w) for w in rest])
