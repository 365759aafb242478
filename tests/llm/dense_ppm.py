"""The law of the context trees as one dense table over few symbols: an independent form for the tests."""

import numpy as np

from tripkpi.llm import textvec as V


class Ppm:
    """Code lengths (bits) of each symbol in each context of ``order`` symbols, one column per language."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = 3, symbols: int = 40):
        self.langs = sorted(samples)
        texts = {k: [V.LOWER[np.frombuffer(t, np.uint8)] for t in v] for k, v in samples.items()}
        freq = sum((np.bincount(t, minlength=256) for v in texts.values() for t in v), np.zeros(256, np.int64))
        own = np.argsort(-freq, kind="stable")[:symbols - 1]
        own = own[freq[own] > 0]
        self.symbol = np.full(256, len(own), np.uint8)
        self.symbol[own] = np.arange(len(own))
        a = self.size = len(own) + 1
        while order > 0 and len(self.langs) * a ** (order + 1) > (1 << 25):
            order -= 1
        self.order = order
        self.pad = int(self.symbol[0x20])
        spread = np.zeros(a)                        # a byte inside the shared symbol
        spread[len(own)] = np.log2(256 - len(own))
        cols = []
        for lang in self.langs:
            prob = np.full((1, a), 1.0 / a)
            for k in range(order + 1):
                n = np.zeros(a ** (k + 1), np.int64)
                for t in texts[lang]:
                    np.add.at(n, self.codes(self.symbol[t], k), 1)
                n = n.reshape(-1, a)
                total, kinds = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
                shorter = np.tile(prob, (len(n) // len(prob), 1))       # the oldest symbol counts most in a code
                whole = np.maximum(total + kinds, 1)
                prob = np.where(total > 0, np.where(n > 0, n / whole, shorter * (kinds / whole)), shorter)
            cols.append((spread - np.log2(prob)).reshape(-1))
        self.bits = np.stack(cols, 1).astype(np.float32)

    def codes(self, sym: np.ndarray, order: int) -> np.ndarray:
        """Context and symbol at each position as one number; the text is preceded by spaces."""
        full = np.concatenate([np.full(order, self.pad, sym.dtype), sym]).astype(np.int32)
        n = len(sym)
        code = full[:n].copy()
        for k in range(1, order + 1):
            code *= self.size
            code += full[k:k + n]
        return code

    def lengths(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits of each text (rows bounds[i] to bounds[i + 1] of ``data``) under each language."""
        sym = self.symbol[V.LOWER[data]]
        out = np.zeros((len(bounds) - 1, len(self.langs)))
        if not len(sym):
            return out
        code = self.codes(sym, self.order)
        # the first positions of a text must not see the text before it
        for k in range(self.order):
            at = bounds[:-1][np.diff(bounds) > k] + k
            head = np.zeros(len(at), np.int64)
            for j in range(self.order, -1, -1):
                head = head * self.size + (sym[at - j] if j <= k else self.pad)
            code[at] = head
        some = np.flatnonzero(np.diff(bounds))
        bits = np.take(self.bits, code, axis=0, mode="clip")
        out[some] = np.add.reduceat(bits, bounds[some], axis=0, dtype=np.float64)
        return out

    def more(self, text: np.ndarray) -> np.ndarray:
        """Bits of a text's bytes after its first ``order``, which are context only."""
        return np.take(self.bits, self.codes(self.symbol[V.LOWER[text]], self.order)[self.order:], axis=0).sum(0, dtype=np.float64)
