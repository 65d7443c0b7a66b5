"""A byte-fallback BPE vocabulary compiled to a deterministic transducer that emits token counts.

In the encoding of a text, the tokens before any cut between two tokens are the encoding of the text before the
cut, and a sequence of tokens is the encoding of its text exactly when every two neighbours are (they do not merge
otherwise when encoded alone). So the last token of a prefix's encoding is the one piece that ends there and may
follow the last token of what precedes it. The transducer's state after some characters is the list of pieces that
may still be under way (a node in the trie of pieces), each with the last token before it and the number of tokens
up to there, counted from here. It is finite: no piece is longer than 16 characters. States and transitions are
made when they are first met; a transition carries the change in the number of tokens, so that their sum over a
text is its number of tokens.

Where no piece holds two neighbouring characters, the state is forgotten: there the transducer is back at its
start, whatever came before. Before a word's space and on both sides of a line end this is always so.
"""

from __future__ import annotations

import re
from functools import lru_cache

SPACE = "▁"  # how the vocabulary writes a space
MAX_ENTRIES = 400_000  # transitions kept, and words kept; beyond it transitions are dropped, and further words walked anew
LONG = 40  # characters of a word that is walked anew each time
_RUNS = re.compile(f"{SPACE}*[^{SPACE}\n]*\n?")


class Pieces:
    """The vocabulary: rank of each piece, and the pieces of spaces alone, which merge after all others."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, float] = {}
        self.runs: set[int] = {1}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            if len(piece) > 1 and not piece.strip(SPACE):
                self.runs.add(len(piece))
            else:
                self.rank[piece] = -model.get_score(i)
        self.multi = [p for p in self.rank if len(p) > 1]
        if any(SPACE in p[1:] for p in self.multi) or any("\n" in p for p in self.rank):
            raise ValueError("pieces that join words or lines are not supported")

    def encode(self, text: str) -> list[str]:
        """Merge the best-ranked neighbours, the leftmost of equals, until none are a piece together."""
        parts = list(text)
        while len(parts) > 1:
            best = min((self.rank.get(a + b, float("inf")), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best[0] == float("inf"):
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return parts


class Transducer:
    def __init__(self, path: str, max_entries: int = MAX_ENTRIES):
        self.pieces, self.max_entries = Pieces(path), max_entries
        rank = self.pieces.rank
        self.children: list[dict[str, int]] = [{}]
        self.piece_at: list[str | None] = [None]
        for p in self.pieces.multi:
            node = 0
            for c in p:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.piece_at.append(None)
                node = self.children[node][c]
            self.piece_at[node] = p
        self.joined = {a + b for p in self.pieces.multi for a, b in zip(p, p[1:])}
        self.cost = {}  # tokens of a character that is no piece: its bytes
        self._rank = rank
        self._follows: dict[tuple[str, str], bool] = {}
        #: State 0 is the start: only a new piece may begin, and nothing stands before it.
        self.states: list[tuple] = [((0, "", 0),)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.steps: list[dict[str, tuple[int, int]]] = [{}]
        self.entries = 0
        self.words: dict[str, int] = {}
        self.run_counts: dict[int, int] = {0: 0}

    def follows(self, before: str, piece: str) -> bool:
        """Whether the two stay apart when encoded together."""
        key = before, piece
        if key not in self._follows:
            if len(self._follows) > self.max_entries:
                self._follows.clear()
            # characters that no piece joins never merge, so only the ends near the cut matter; encode both whole
            self._follows[key] = before[-1:] + piece[0] not in self.joined or self.pieces.encode(before + piece) == [before, piece]
        return self._follows[key]

    def step(self, state: int, c: str) -> tuple[int, int]:
        """The next state, and the change in the number of tokens."""
        last = self.states[state][-1][1]
        if state and last[-1] + c not in self.joined:  # no piece holds both: as from the start
            nxt = self.steps[0].get(c)
            self.steps[state][c] = nxt = nxt if nxt is not None else self.step(0, c)
            self.entries += 1
            return nxt
        live, done = [], None
        for node, before, count in self.states[state]:
            child = self.children[node].get(c)
            if child is None:
                if node == 0 and done is None:
                    done = c, count + self.single(c)
                continue
            piece = self.piece_at[child] if node else c
            if piece is not None and (not before or self.follows(before, piece)):
                done = piece, count + (1 if node else self.single(c))
            if self.children[child]:
                live.append((child, before, count))
        if done is None:
            raise AssertionError("no piece ends here")
        last, total = done
        live.append((0, last, total))
        key = tuple((node, before, count - total) for node, before, count in live)
        found = self.number.get(key)
        if found is None:
            found = self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
        self.steps[state][c] = found, total
        self.entries += 1
        return found, total

    def single(self, c: str) -> int:
        if c not in self.cost:
            if len(self.cost) > self.max_entries:
                self.cost.clear()
            self.cost[c] = 1 if c in self._rank else len(c.encode("utf-8", "replace"))
        return self.cost[c]

    def forget(self) -> None:
        """Drop all states but the start, and what tells neighbours apart; they are made again when met."""
        self._follows.clear()
        del self.states[1:], self.steps[1:]
        self.steps[0].clear()
        self.number = {self.states[0]: 0}
        self.entries = 0

    def walk(self, word: str) -> int:
        """Number of tokens of a text without runs of spaces, from the start state."""
        if self.entries > self.max_entries:
            self.forget()
        state = total = 0
        steps = self.steps
        for c in word:
            nxt = steps[state].get(c)
            state, emitted = nxt if nxt is not None else self.step(state, c)
            total += emitted
        return total

    def word(self, word: str) -> int:
        """As ``walk``: the way of a frequent word from the start and back to it, kept as one transition."""
        n = self.words.get(word)
        if n is None:
            n = self.walk(word)
            if len(word) <= LONG and len(self.words) < self.max_entries:
                self.words[word] = n
        return n

    def spaces(self, k: int) -> int:
        """Tokens of k spaces in a row that merge with nothing else: leftmost first, all ranks equal."""
        if k not in self.run_counts:
            parts, i = [1] * k, 0
            while i + 1 < len(parts):
                if parts[i] + parts[i + 1] in self.pieces.runs:
                    parts[i : i + 2] = [parts[i] + parts[i + 1]]
                    i = max(0, i - 1)
                else:
                    i += 1
            if len(self.run_counts) > 10_000:
                return len(parts)
            self.run_counts[k] = len(parts)
        return self.run_counts[k]

    def count(self, text: str) -> int:
        """Tokens of a text in which spaces are already written as the vocabulary writes them."""
        if SPACE + SPACE not in text:
            words = self.words
            units = text.replace(SPACE, " " + SPACE).replace("\n", " \n ").split(" ")
            total = 0
            for w in units:
                n = words.get(w)
                total += self.word(w) if n is None else n
            return total
        total = 0
        for m in _RUNS.finditer(text):
            unit = m.group()
            run = len(unit) - len(unit.lstrip(SPACE))
            if run < 2:
                total += self.word(unit)
                continue
            rest = unit[run - 1 :]
            first = self.alone(rest)
            total += self.spaces(run) + self.word(rest) - 1 if first else self.spaces(run - 1) + self.word(rest)
        return total

    def alone(self, word: str) -> bool:
        """Whether the space before a word stays a token of its own."""
        return len(word) < 2 or SPACE + word[1] not in self.joined or self.pieces.encode(word)[0] == SPACE


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per Python worker."""
    return Transducer(path)
