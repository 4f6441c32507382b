"""A bidirectional LSTM over characters with CRF transitions between tags, in numpy."""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
#: Tags: outside, and for each kind its first and its further characters.
O, TAGS = 0, 1 + 2 * len(KINDS)
#: Character codes: ASCII, other letters, other characters, and what stands past the end of a text.
LETTER, OTHER, PAD, CODES = 128, 129, 130, 131
#: Columns that a product takes at a time: larger ones are shared among threads, which at this size wait for each other.
ALONE = 320


def codes_of(text: str, step: int = 1 << 20) -> np.ndarray:
    """The code of each character."""
    out = []
    for i in range(0, len(text), step):
        points = np.frombuffer(text[i : i + step].encode("utf-32-le", "replace"), np.uint32)
        # Letters beyond ASCII are those of the alphabets from Latin-1 on; signs and blanks of their own are not.
        letter = ((points >= 0xC0) & (points != 0xD7) & (points != 0xF7) & (points < 0x2000)) | (points >= 0x2C00)
        out.append(np.where(points < 128, points, np.where(letter, LETTER, OTHER)).astype(np.uint8))
    return np.concatenate(out) if out else np.zeros(0, np.uint8)


def tags_of(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """A tag for each of `n` characters; of overlapping spans the first one holds."""
    out = np.zeros(n, np.int64)
    for kind, start, end in spans:
        if not out[start:end].any():
            out[start:end] = 2 + 2 * kind
            out[start] = 1 + 2 * kind
    return out


def spans_of(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the runs of tags of one kind; a first character begins a new one."""
    kind = (tags.astype(np.int64) + 1) // 2 - 1
    edge = np.concatenate([[True], (kind[1:] != kind[:-1]) | (tags[1:] % 2 == 1)])
    starts = np.flatnonzero(edge[: len(tags)])
    ends = np.concatenate([starts[1:], [len(tags)]])[: len(starts)]
    return [(int(kind[s]), int(s), int(e)) for s, e in zip(starts, ends, strict=True) if kind[s] >= 0]


def summed_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def squash(x: np.ndarray, square: np.ndarray | None = None) -> np.ndarray:
    """x (27 + x^2) / (27 + 9 x^2) between -3 and 3, where it reaches -1 and 1, in place: close to tanh, at a third of
    its time. `square` is room for the square."""
    np.clip(x, -3, 3, out=x)
    square = np.multiply(x, x, out=square)
    square += 27
    x *= square
    square *= 9
    square -= 216
    x /= square
    return x


def slope(x: np.ndarray) -> np.ndarray:
    """Derivative of `squash` at x."""
    square = np.minimum(x * x, 9)
    return ((square - 9) / (3 * (square + 3))) ** 2


class SpanNet:
    """Both directions run side by side, the second over reversed characters. A gate is (1 + squash) / 2."""

    def __init__(self, hidden: int = 8, embed: int = 8, seed: int = 5):
        r = np.random.default_rng(seed)
        draw = lambda scale, *shape: r.normal(0, scale, shape).astype(np.float32)
        self.hidden, self.embed = hidden, embed
        #: `gates` has a row per gate unit, and columns for the character, a constant and the hidden state.
        self.p = {
            "embed": draw(0.5, CODES, embed),
            "gates": draw(0.3, 2, 4 * hidden, embed + 1 + hidden),
            "out": draw(0.3, TAGS, 2 * hidden),
            "tag": np.zeros(TAGS, np.float32),
            "step": np.zeros((TAGS, TAGS), np.float32),
            "first": np.zeros(TAGS, np.float32),
        }
        self.p["gates"][:, hidden : 2 * hidden, embed] = 0.5  # remember at first
        self.p["tag"][O] = 1.0

    def states(self, codes: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """What the gates see (character, constant, hidden state), by place, direction, unit and row of `codes` (rows,
        places), the second direction in its own order; the hidden state stands one place further."""
        n, length = codes.shape
        h, e = self.hidden, self.embed
        both = np.ascontiguousarray(np.stack([codes, codes[:, ::-1]]).transpose(2, 0, 1))  # place, direction, row
        z = np.zeros((length + 1, 2, e + 1 + h, n), np.float32)
        z[:-1, :, :e] = self.p["embed"][both].transpose(0, 1, 3, 2)
        z[:, :, e] = 1
        c = np.zeros((2, h, n), np.float32)
        if keep is not None:
            keep.update(codes=both, sums=np.empty((length, 2, 4 * h, n), np.float32), cells=np.zeros((length + 1, 2, h, n), np.float32))
        a, room = np.empty((2, 4 * h, n), np.float32), np.empty((2, 4 * h, n), np.float32)
        shown, small = np.empty_like(c), np.empty_like(c)
        i, f, o, g = (a[:, k * h : (k + 1) * h] for k in range(4))
        open_, hidden = a[:, : 3 * h], z[:, :, e + 1 :]
        for t in range(length):
            for j in range(0, n, ALONE):
                np.matmul(self.p["gates"], z[t, :, :, j : j + ALONE], out=a[:, :, j : j + ALONE])
            if keep is not None:
                keep["sums"][t] = a
            squash(a, room)
            open_ += 1
            c *= f
            i *= g
            c += i
            c *= 0.5
            np.copyto(shown, c)
            squash(shown, small)
            o *= 0.5
            np.multiply(o, shown, out=hidden[t + 1])
            if keep is not None:
                keep["cells"][t + 1] = c
        return z

    def emissions(self, z: np.ndarray) -> np.ndarray:
        """Scores of the tags by place, tag and row."""
        h, out = self.hidden, self.p["out"]
        e = np.matmul(out[:, :h], z[1:, 0, -h:])
        e += np.matmul(out[:, h:], z[:0:-1, 1, -h:])
        e += self.p["tag"][:, None]
        return e

    def chances(self, e: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the tags under the CRF, and its gradient by e (place, row and tag), step and
        first."""
        length, n, _ = e.shape
        step, first = self.p["step"], self.p["first"]
        ahead = np.empty_like(e)
        ahead[0] = e[0] + first
        for t in range(1, length):
            ahead[t] = e[t] + summed_exp(ahead[t - 1][:, :, None] + step, 1)
        whole = summed_exp(ahead[-1], 1)
        behind = np.zeros_like(e)
        for t in range(length - 2, -1, -1):
            behind[t] = summed_exp(step + (e[t + 1] + behind[t + 1])[:, None, :], 2)
        d_e = np.exp(ahead + behind - whole[None, :, None])
        d_step = np.zeros_like(step)
        for t in range(length - 1):
            d_step += np.exp(ahead[t][:, :, None] + step + (e[t + 1] + behind[t + 1])[:, None, :] - whole[:, None, None]).sum(axis=0)
        d_first = d_e[0].sum(axis=0)
        rows, places = np.arange(n), np.arange(length)[:, None]
        right = tags.T
        score = e[places, rows, right].sum() + first[right[0]].sum() + step[right[:-1], right[1:]].sum()
        d_e[places, rows, right] -= 1
        d_first = d_first - np.bincount(right[0], minlength=TAGS)
        d_step = d_step - np.bincount((right[:-1] * TAGS + right[1:]).reshape(-1), minlength=TAGS * TAGS).reshape(TAGS, TAGS)
        return float(whole.sum() - score) / n, {"e": d_e / n, "step": d_step / n, "first": d_first / n}

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        keep: dict = {}
        h, width, (n, length) = self.hidden, self.embed, codes.shape
        z = self.states(codes, keep)
        loss, g = self.chances(np.ascontiguousarray(self.emissions(z).transpose(0, 2, 1)), tags)
        d_e = g.pop("e").astype(np.float32)
        g["tag"] = d_e.sum(axis=(0, 1))
        flat = lambda x: np.ascontiguousarray(x.transpose(1, 0, 2)).reshape(x.shape[1], -1)  # noqa: E731  (unit, place and row)
        by_tag = d_e.transpose(2, 0, 1).reshape(TAGS, -1)
        g["out"] = np.concatenate([by_tag @ flat(x).T for x in (z[1:, 0, -h:], z[:0:-1, 1, -h:])], axis=1)
        turned = d_e.transpose(0, 2, 1)
        d_states = np.stack([np.matmul(self.p["out"][:, :h].T, turned), np.matmul(self.p["out"][:, h:].T, turned)[::-1]], axis=1)
        d_gates = np.empty_like(keep["sums"])
        d_h, d_c = np.zeros((2, h, n), np.float32), np.zeros((2, h, n), np.float32)
        back = np.ascontiguousarray(self.p["gates"][:, :, -h:].transpose(0, 2, 1))
        for t in range(length - 1, -1, -1):
            sums, cell, before = keep["sums"][t], keep["cells"][t + 1], keep["cells"][t]
            a, now = squash(sums.copy()), squash(cell.copy())
            i, f, o, new = (a[:, k * h : (k + 1) * h] for k in range(4))
            d_h = d_h + d_states[t]
            d_c = d_c + d_h * 0.5 * (1 + o) * slope(cell)
            d = 0.5 * np.concatenate([d_c * new, d_c * before, d_h * now, d_c * (1 + i)], axis=1) * slope(sums)
            d_gates[t] = d
            d_c = d_c * 0.5 * (1 + f)
            d_h = np.matmul(back, d)
        g["gates"], g["embed"] = np.empty_like(self.p["gates"]), np.zeros_like(self.p["embed"])
        for side in (0, 1):
            d = flat(d_gates[:, side])
            g["gates"][side] = d @ flat(z[:-1, side]).T
            seen = (keep["codes"][:, side].reshape(1, -1) == np.arange(CODES)[:, None]).astype(np.float32)
            g["embed"] += seen @ (self.p["gates"][side, :, :width].T @ d).T
        return loss, g

    def fit(self, texts: list[str], tags: list[np.ndarray], length: int, steps: int = 360, batch: int = 64, rate: float = 0.02, seed: int = 5) -> SpanNet:
        """Adam over `steps` shuffled batches of windows of `length` characters."""
        codes, right = np.full((len(texts), length), PAD, np.uint8), np.zeros((len(texts), length), np.int64)
        for i, (text, own) in enumerate(zip(texts, tags, strict=True)):
            codes[i, : len(text)], right[i, : len(own)] = codes_of(text), own
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        while step < steps:
            order = r.permutation(len(texts))
            for i in range(0, batch * min(steps - step, -(-len(order) // batch)), batch):
                _, g = self.gradients(codes[order[i : i + batch]], right[order[i : i + batch]])
                size = float(np.sqrt(sum((v * v).sum() for v in g.values())))
                step += 1
                now = rate * (1 - step / (steps + 1))
                for k, v in g.items():
                    v = v * min(1.0, 5.0 / max(size, 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * v
                    s[k] = 0.999 * s[k] + 0.001 * v * v
                    self.p[k] = self.p[k] - (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def may_leave(self, e: np.ndarray) -> np.ndarray:
        """Whether the likeliest path of a row may leave the outside tag: no path that stays outside is worth less than
        one of which each stretch of other tags, with its steps in and back, adds nothing. Within a stretch the best
        tag of a place and the best step to it are taken for each place by itself, so that the bound is never too low."""
        step, first = self.p["step"], self.p["first"]
        within = step[1:, 1:].max(axis=0) - step[O, O]
        back = float(step[1:, O].max() - step[O, O])
        others, outside = e[:, 1:], e[:, O]
        enter = (others + (step[O, 1:] - step[O, O])[:, None]).max(axis=1) - outside
        enter[0] = (others[0] + (first[1:] - first[O])[:, None]).max(axis=0) - outside[0]
        stay = (others + within[:, None]).max(axis=1) - outside
        worth, best = enter[0].copy(), enter[0] + back
        for t in range(1, len(e)):
            worth += stay[t]
            np.maximum(worth, enter[t], out=worth)
            np.maximum(best, worth + back, out=best)
        return np.maximum(best, worth) > -1e-4  # room for rounding

    def best_tags(self, e: np.ndarray) -> np.ndarray:
        """The likeliest tags of each row (Viterbi), by row and place, for scores by place, tag and row."""
        length, _, n = e.shape
        step, first = self.p["step"], self.p["first"]
        out = np.zeros((n, length), np.uint8)
        rows = np.flatnonzero(self.may_leave(e))
        if not len(rows):
            return out
        e = np.ascontiguousarray(e[:, :, rows].transpose(0, 2, 1))
        score, came = e[0] + first, np.zeros((length, len(rows), TAGS), np.uint8)
        for t in range(1, length):
            ways = score[:, :, None] + step
            came[t] = ways.argmax(axis=1)
            score = np.take_along_axis(ways, came[t][:, None, :].astype(np.int64), 1)[:, 0] + e[t]
        at = score.argmax(axis=1)
        for t in range(length - 1, -1, -1):
            out[rows, t] = at
            at = came[t][np.arange(len(rows)), at]
        return out

    def tags(self, codes: list[np.ndarray], length: int, margin: int, rows: int = 4 * ALONE) -> list[np.ndarray]:
        """The tag of each character of each text: windows of `length` characters overlap by twice the margin, and
        each character has its tag from the window in which it is farther from an end."""
        starts = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
        data = np.concatenate([*codes, np.full(1, PAD, np.uint8)])
        stride = length - 2 * margin
        n = [max(1, -(-(len(c) - 2 * margin) // stride)) if len(c) else 0 for c in codes]
        owner = np.repeat(np.arange(len(codes)), n)
        first = starts[owner] + stride * (np.arange(len(owner)) - np.repeat(np.cumsum([0, *n])[:-1], n))
        out = np.zeros(len(data), np.uint8)
        for i in range(0, len(owner), rows):
            own, at = owner[i : i + rows], first[i : i + rows]
            place = at[:, None] + np.arange(length)
            inside = place < starts[own + 1][:, None]
            windows = np.where(inside, data[np.minimum(place, len(data) - 1)], PAD).astype(np.uint8)
            best = self.best_tags(self.emissions(self.states(windows)))
            mine = inside & ((np.arange(length) >= margin) | (at == starts[own])[:, None])
            mine[:, length - margin :] &= (place[:, -1] + 1 >= starts[own + 1])[:, None]
            out[place[mine]] = best[mine]
        return [out[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
