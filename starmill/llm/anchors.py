"""Content-defined places in texts, found alike in every copy of a passage."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from starmill.llm.common import mix64

_FACTOR = 0x9E3779B1
#: Window starts worked on at once; the place of a run has to fit into 16 bits.
PIECE = 60_000


def _mixed_grams(data: np.ndarray, length: int) -> np.ndarray:
    """A 32-bit hash of every run of ``length`` bytes, built from shorter runs."""
    done, size = data.astype(np.uint32) + np.uint32(1), 1
    sums = {1: done}
    while size * 2 <= length:
        done = done[:-size] + done[size:] * np.uint32(pow(_FACTOR, size, 2**32))
        size *= 2
        sums[size] = done
    n = len(data) - length + 1
    out, covered = sums[size][:n], size
    for part in sorted(sums, reverse=True)[1:]:
        if covered + part <= length:
            out = out + sums[part][covered : covered + n] * np.uint32(pow(_FACTOR, covered, 2**32))
            covered += part
    out = out ^ (out >> np.uint32(15))
    out *= np.uint32(0x85EBCA6B)
    out ^= out >> np.uint32(13)
    out *= np.uint32(0xC2B2AE35)
    return out


def _leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of every ``width`` neighbouring values stands.

    Only the upper 16 bits count; ties go to the left by the place in the lower ones.
    """
    best = (values & np.uint32(0xFFFF0000)) | np.arange(len(values), dtype=np.uint32)
    size = 1
    while size * 2 <= width:
        best = np.minimum(best[:-size], best[size:])
        size *= 2
    rest = width - size
    if rest:
        best = np.minimum(best[:-rest], best[rest:])
    return (best & np.uint32(0xFFFF)).astype(np.int64)


@dataclass
class Anchors:
    """The anchors of several texts and the windows that each stands for.

    Of the runs of ``gram`` bytes in a window of ``match`` bytes one is its anchor, the
    one with the smallest hash, so that equal windows have anchors at equal places.
    Windows that start at ``first[i]`` to ``last[i]`` have the anchor at ``at[i]``; all
    are places in the common buffer. ``text[i]`` is the number of the text.
    """

    text: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @staticmethod
    def of(data: np.ndarray, starts: np.ndarray, gram: int, match: int) -> Anchors:
        parts: list[tuple] = []
        for begin in range(int(starts[0]), int(starts[-1]) - match + 1, PIECE):
            end = min(begin + PIECE, int(starts[-1]) - match + 1)
            chosen = _leftmost_minima(
                _mixed_grams(data[begin : end + match - 1], gram), match - gram + 1
            )
            place = np.arange(begin, end)
            text = np.searchsorted(starts, place, side="right") - 1
            # Windows that reach into the next text are none.
            whole = place + match <= starts[text + 1]
            place, text, chosen = place[whole], text[whole], chosen[whole] + begin
            if not len(place):
                continue
            new = np.flatnonzero(
                (np.diff(chosen, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0)
            )
            last = np.append(new[1:], len(place)) - 1
            parts.append((text[new], chosen[new], place[new], place[last]))
        if not parts:
            return Anchors(*(np.zeros(0, np.int64) for _ in range(4)))
        return Anchors(*(np.concatenate(x) for x in zip(*parts)))

    def hashes(self, data: np.ndarray, gram: int) -> np.ndarray:
        """64-bit hashes of the runs at the anchors."""
        out = np.full(len(self.at), gram, np.uint64)
        for a in range(0, len(self.at), 1 << 16):
            at = self.at[a : a + (1 << 16)]
            rows = np.zeros((len(at), -(-gram // 8) * 8), np.uint8)
            rows[:, :gram] = data[at[:, None] + np.arange(gram)]
            for word in rows.view("<u8").T:
                with np.errstate(over="ignore"):
                    out[a : a + len(at)] = mix64(out[a : a + len(at)] * np.uint64(3) + word, 51)
        return out
