"""Gated recurrent network over word ids with a class-factored output, in numpy.

Before each token the state gives a softmax over classes. Head classes hold at most HEAD_CLASS words each and give a second
softmax over their members from the state. The words of every other class are the leaves of a binary tree: each of its nodes
says from the state which way to go, so each word has a chance of its own. An input is a row of the table, and a hashed row too
for words that share the first. Only the nodes and hashed rows met are learnt in a step. Texts are laid side by side in
slots, one behind another; a slot's state is cleared where a text begins and carried across windows otherwise, so a text is
scored as a whole however long it is. Gradients go back `window` steps. Inside a window numbers of the state lie first and
tokens last, so that numpy works on long rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

HEAD_CLASS = 32
#: Parts of which a step learns only the rows met.
SPARSE = ("hashed", "tree")
SPARSE_RATE = 0.02
#: Tokens of which the chances of all classes are held at once: few enough to stay in a core's own memory.
_AT_ONCE = 512


@dataclass(frozen=True)
class Shape:
    inputs: int
    classes: int
    head_classes: int
    hidden: int = 16
    window: int = 32
    slots: int = 256
    #: Slots of a step of learning: fewer, so that as many steps are made as before slots were kept full.
    learn_slots: int = 128
    #: Words of each class behind the head classes; a class of m words has m - 1 nodes.
    leaves: tuple[int, ...] = ()
    #: An input is row + inputs * hashed row; hashed row 0 is none.
    hashed: int = 0

    def nodes(self) -> np.ndarray:
        """First node of each class behind the head classes, and the number of all."""
        return np.cumsum([0, *[max(m - 1, 0) for m in self.leaves]], dtype=np.int64)

    def parts(self) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        out = {
            "table": (self.inputs, 3 * h), "state": (h, 3 * h), "class": (h, self.classes), "class_bias": (self.classes,),
            "word": (self.head_classes, h, HEAD_CLASS), "word_bias": (self.head_classes, HEAD_CLASS),
        }
        if self.nodes()[-1]:
            out["tree"] = (int(self.nodes()[-1]), h + 1)  # the last column is the bias
        if self.hashed:
            out["hashed"] = (self.hashed + 1, 3 * h)
        return out


def tree_bias(counts: np.ndarray) -> np.ndarray:
    """Biases of the nodes 1 to m - 1 of a class, so that m words have their shares of `counts`; node i has the children 2i and 2i + 1."""
    m = len(counts)
    below = np.concatenate([np.zeros(m), counts.astype(np.float64)])
    for level in range(m.bit_length(), -1, -1):
        at = np.arange(1 << level, min(2 << level, m))
        below[at] = below[2 * at] + below[2 * at + 1]
    at = np.arange(1, m)
    return np.log(below[2 * at + 1] / below[2 * at])


def start(shape: Shape, class_bias: np.ndarray, word_bias: np.ndarray, seed: int = 11, node_bias: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """Small random weights; the biases make the first model the unigram one."""
    random = np.random.default_rng(seed)
    out = {
        name: np.zeros(size, np.float32) if name in SPARSE else (random.standard_normal(size) * 0.1).astype(np.float32)
        for name, size in shape.parts().items()
    }
    out["class_bias"], out["word_bias"] = class_bias.astype(np.float32), word_bias.astype(np.float32)
    out["class"] *= 0.1
    out["word"] *= 0.1
    if "tree" in out and node_bias is not None:
        out["tree"][:, -1] = node_bias
    return out


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in sorted(weights)])


def shaped(values: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    """Views of `values`, which has to be copied before it is learnt from."""
    out, at = {}, 0
    for name, size in sorted(shape.parts().items()):
        n = int(np.prod(size))
        out[name] = values[at:at + n].reshape(size).astype(np.float32, copy=False)
        at += n
    return out


def laid_out(lengths: np.ndarray, slots: int, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slot, first row, rows per slot, most first, place of each slot) of texts dealt to slots, the longest first to the shortest slot.

    `before` has the rows that already lie in each of `slots` slots.
    """
    if before is None:
        slots = max(1, min(slots, len(lengths)))
        before = np.zeros(slots, np.int64)
    load = before.copy()
    slot, row = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for begin in range(0, len(order), slots):
        part = order[begin:begin + slots]
        into = np.argsort(load, kind="stable")[:len(part)]
        slot[part], row[part] = into, load[into]
        load[into] += lengths[part]
    rank = np.argsort(-load, kind="stable")
    place = np.empty(slots, np.int64)
    place[rank] = np.arange(slots)
    return place[slot], row, load[rank], place


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _softmax(x: np.ndarray, target: np.ndarray, weight: np.ndarray | np.floating | None) -> np.ndarray:
    """ln p of the targets; with a weight every column of x becomes its gradient, so many times."""
    x -= x.max(axis=0)
    every = np.arange(x.shape[1])
    chosen = x[target, every]
    np.exp(x, out=x)
    total = x.sum(axis=0)
    if weight is not None:
        x *= weight / total
        x[target, every] -= weight
    return chosen - np.log(total)


def _order(ids: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers below 2^32, 16 bits at a time, which numpy sorts by counting."""
    order = np.argsort((ids & 0xFFFF).astype(np.uint16), kind="stable")
    if len(ids) and int(ids.max()) >> 16:
        order = order[np.argsort((ids[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def _cuts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, id) of the runs of equal ids."""
    cuts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    return cuts, ids[cuts]


def _whole(rows: np.ndarray) -> np.ndarray:
    """Every row as one item, which numpy moves in one piece."""
    return rows.view(f"V{rows.itemsize * rows.shape[1]}")[:, 0]


def _add_to(into: np.ndarray, ids: np.ndarray, change: np.ndarray) -> None:
    """Adds to rows of `into`, each named once."""
    now = into.take(ids, axis=0)
    now += change
    _whole(into)[ids] = _whole(now)


def _run_sums(rows: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of the rows of each run; of an even number of columns two are added at once, as a complex number."""
    if rows.shape[1] % 2:
        return np.add.reduceat(rows, cuts, axis=0)
    return np.add.reduceat(rows.view(f"c{2 * rows.itemsize}"), cuts, axis=0).view(rows.dtype)


class Network:
    """Weights, and the two things to do with a block of texts: score it, or learn from it."""

    def __init__(self, shape: Shape, weights: dict[str, np.ndarray], rate: float = 0.004):
        self.shape, self.w, self.rate, self.steps = shape, weights, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items() if k not in SPARSE}
        self.square = {k: np.zeros_like(v) if k not in SPARSE else np.zeros(len(v), v.dtype) for k, v in weights.items()}
        #: Steps that met each row of a sparse part, and the last step's (rows, gradients).
        self.met = {k: np.zeros(len(v), np.float32) for k, v in weights.items() if k in SPARSE}
        self.rows: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        heads = np.zeros(shape.head_classes, np.int32)
        self.leaves = np.concatenate([heads, np.array(shape.leaves, np.int32)])
        self.nodes = np.concatenate([heads, shape.nodes().astype(np.int32)])
        self.held: dict[str, np.ndarray] = {}

    def _buffer(self, name: str, *size: int) -> np.ndarray:
        """Array of this size in memory that is used again and again."""
        need = math.prod(size)
        if name not in self.held or self.held[name].size < need:
            self.held[name] = np.empty(need, self.w["state"].dtype)
        return self.held[name][:need].reshape(size)

    def _spaced(self, name: str, rows: int, steps: int, slots: int) -> np.ndarray:
        """(rows, steps, slots) with a step's gap behind each row: rows a power of two apart would share the same few places of the cache."""
        return self._buffer(name, rows, steps + 1, slots)[:, :steps]

    def run(self, lengths: np.ndarray, inputs: np.ndarray, classes: np.ndarray, members: np.ndarray, learn: bool) -> np.ndarray:
        """ln p of every token; `members` is the place in its class, any number in a class without leaves."""
        slot, first, load, _ = laid_out(lengths, self.shape.slots)
        bottom = np.cumsum(load) - load
        # A slot's tokens lie one behind another, so memory follows the tokens, not the longest text.
        own = np.arange(int(lengths.sum())) + np.repeat(bottom[slot] + first - (np.cumsum(lengths) - lengths), lengths)
        stacked = [np.empty_like(x) for x in (inputs, classes, members)]
        for into, values in zip(stacked, (inputs, classes, members), strict=True):
            into[own] = values
        fresh = np.zeros(len(inputs), bool)
        fresh[(bottom[slot] + first)[lengths > 0]] = True
        out = np.zeros(len(inputs), np.float64)
        self._windows(load, fresh, stacked, np.zeros((self.shape.hidden, len(load)), np.float32), learn, 1, out)
        return out[own]

    def learn(self, blocks: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> int:
        """Learns from blocks of (lengths, inputs, classes, members); the number of their tokens.

        Where more than a quarter of the slots has run out of texts, what lies in the others waits for the next block with its
        states, so that steps are made from full windows; no token is left out.
        """
        slots, seen = min(self.shape.slots, self.shape.learn_slots), 0
        left, state = np.zeros(slots, np.int64), np.zeros((self.shape.hidden, slots), np.float32)
        waiting, waiting_fresh = [np.zeros(0, np.int32)] * 3, np.zeros(0, bool)
        for lengths, *values in blocks:
            seen += int(lengths.sum())
            slot, first, load, place = laid_out(lengths, slots, left)
            bottom = np.cumsum(load) - load
            old = np.arange(len(waiting_fresh)) + np.repeat(bottom[place] - (np.cumsum(left) - left), left)
            own = np.arange(int(lengths.sum())) + np.repeat(bottom[slot] + first - (np.cumsum(lengths) - lengths), lengths)
            fresh = np.zeros(int(load.sum()), bool)
            fresh[old] = waiting_fresh
            fresh[(bottom[slot] + first)[lengths > 0]] = True
            stacked = [np.empty(len(fresh), np.int32) for _ in values]
            for into, waits, new in zip(stacked, waiting, values, strict=True):
                into[old], into[own] = waits, new
            moved = np.empty_like(state)
            moved[:, place] = state
            done, state = self._windows(load, fresh, stacked, moved, True, -(-3 * slots // 4))
            left = np.maximum(load - done, 0)
            stay = np.arange(int(left.sum())) + np.repeat(bottom + load - left - (np.cumsum(left) - left), left)
            waiting, waiting_fresh = [x[stay] for x in stacked], fresh[stay]
        self._windows(left, waiting_fresh, waiting, state, True, 1)
        return seen

    def _windows(self, load, fresh, stacked, state, learn, least, out=None) -> tuple[int, np.ndarray]:
        """Runs the windows, as long as `least` slots hold a token, over slots with `load` tokens one behind another; the most first."""
        bottom, begin, top = np.cumsum(load) - load, 0, int(load[0]) if len(load) else 0
        while begin < top:
            active = int(np.searchsorted(-load, -begin, "left"))
            if active < least:
                break
            row = np.arange(begin, min(begin + self.shape.window, top))[:, None]
            used = row < load[:active]
            token = np.where(used, bottom[:active] + row, 0)
            log_p, after = self._window(state[:, :active], fresh[token], used, *[x[token] for x in stacked], learn)
            state = np.hstack([after, state[:, active:]]) if active < state.shape[1] else after
            if out is not None:
                out[token[used]] = log_p[used]
            begin += self.shape.window
        return begin, state

    def _window(self, state, fresh, used, inputs, classes, members, learn):
        w, h = self.w, self.shape.hidden
        steps, slots = inputs.shape
        size, kind = steps * slots, w["state"].dtype
        self.rows = {}
        hashed = inputs.ravel() // self.shape.inputs
        known = inputs.ravel() - hashed * self.shape.inputs
        x = np.take(w["table"], known, axis=0, out=self._buffer("x", size, 3 * h), mode="clip")
        if self.shape.hashed:
            some = np.flatnonzero(hashed)
            _add_to(x, some, w["hashed"].take(hashed[some], axis=0))
        x = x.reshape(steps, slots, 3 * h)
        before = self._spaced("before", h, steps, slots)
        weights = np.ascontiguousarray(w["state"].T)
        kept = []
        keep = (~fresh).astype(np.float32)
        for t in range(steps):
            now = np.multiply(state, keep[t], out=before[:, t])
            own, u = x[t].T, weights @ now
            gates = u[:2 * h]
            gates += own[:2 * h]
            _sigmoid(gates)
            new = gates[h:] * u[2 * h:]
            new += own[2 * h:]
            np.tanh(new, out=new)
            kept.append((gates, new, u[2 * h:]))
            state = now - new
            state *= gates[:h]
            state += new
        states = before.reshape(h, size)
        target, member, used = classes.ravel(), members.ravel(), used.ravel()
        scale = kind.type(1 / max(np.count_nonzero(used), 1)) if learn else 0
        log_p = np.empty(size, np.float64)
        grads = {name: np.zeros_like(w[name]) for name in ("class", "class_bias", "word", "word_bias")} if learn else {}
        d_states = self._spaced("d_states", h, steps, slots).reshape(h, size) if learn else None
        weights, bias = np.ascontiguousarray(w["class"].T), w["class_bias"][:, None]
        for begin in range(0, size, _AT_ONCE):
            part = slice(begin, min(begin + _AT_ONCE, size))
            seen = states[:, part]
            logits = weights @ seen
            logits += bias
            log_p[part] = _softmax(logits, target[part], used[part] * scale if learn else None)
            if learn:
                grads["class"] += seen @ logits.T
                grads["class_bias"] += logits.sum(axis=1)
                np.matmul(w["class"], logits, out=d_states[:, part])
        self._heads(states, target, member, used, log_p, d_states, scale, grads)
        if "tree" in w:
            self._tree(states, target, member, used, log_p, d_states, scale)
        if learn:
            self._back(before, kept, keep, known, hashed if self.shape.hashed else None, d_states.reshape(h, steps, slots), grads)
        return log_p.reshape(steps, slots), state

    def _heads(self, states, target, member, used, log_p, d_states, scale, grads) -> None:
        """Adds ln p inside the head classes; the gradients if `d_states` is given."""
        w = self.w
        head = np.flatnonzero(used & (target < self.shape.head_classes))
        head = head[_order(target[head])]
        cuts = np.searchsorted(target[head], np.arange(self.shape.head_classes + 1)).tolist()
        met = [(c, slice(cuts[c], cuts[c + 1])) for c in range(self.shape.head_classes) if cuts[c] < cuts[c + 1]]
        seen = states.take(head, axis=1)
        logits = np.empty((HEAD_CLASS, len(head)), states.dtype)
        logits[:] = w["word_bias"].T.take(target[head], axis=1)
        for c, own in met:
            logits[:, own] += w["word"][c].T @ seen[:, own]
        log_p[head] += _softmax(logits, member[head], None if d_states is None else scale)
        if d_states is None:
            return
        d_seen = np.empty_like(seen)
        for c, own in met:
            grads["word"][c] = seen[:, own] @ logits[:, own].T
            grads["word_bias"][c] = logits[:, own].sum(axis=1)
            d_seen[:, own] = w["word"][c] @ logits[:, own]
        d_states[:, head] += d_seen

    def _tree(self, states, target, member, used, log_p, d_states, scale) -> None:
        """Adds ln p inside the classes with leaves, from the leaf up; the gradients if `d_states` is given."""
        own = np.flatnonzero(used & (target >= self.shape.head_classes))
        own = own[self.leaves[target[own]] > 1]
        if not len(own):
            return
        # The shallowest leaves last, so that those still on their way up are the first; of one depth by place, so that rows of
        # the tree that lie side by side are read one after another.
        code, first = self.leaves[target[own]] + member[own], self.nodes[target[own]] - 1
        order = _order(first + code)
        order = order[np.argsort((64 - np.frexp(code[order].astype(np.float64))[1]).astype(np.uint8), kind="stable")]
        own, code, first = own[order], code[order], first[order]
        tree, h = self.w["tree"], self.shape.hidden
        seen, ones = np.ones((len(own), h + 1), states.dtype), np.ones(h + 1, states.dtype)
        seen[:, :h] = states.take(own, axis=1).T
        gain, d_seen = np.zeros(len(own), states.dtype), np.zeros((len(own), h + 1), states.dtype) if d_states is not None else None
        met, many = [], len(own)
        while True:
            right, code = code & 1, code >> 1
            many = np.count_nonzero(code)
            if not many:
                break
            right, code, first = right[:many], code[:many], first[:many]
            node = first + code
            at = np.take(tree, node, axis=0, out=self._buffer("at", many, h + 1), mode="clip")
            sign = np.subtract(1, 2 * right, dtype=states.dtype)
            x = np.multiply(seen[:many], at, out=self._buffer("products", many, h + 1)) @ ones
            x *= sign
            np.minimum(x, 60, out=x)
            np.exp(x, out=x)
            x += 1
            gain[:many] -= np.log(x)
            if d_states is not None:
                np.reciprocal(x, out=x)
                x = (1 - x) * sign
                x *= scale
                at *= x[:, None]
                d_seen[:many] += at
                met.append((node, x))
        log_p[own] += gain
        if d_states is not None:
            d_states[:, own] += d_seen[:, :h].T
            place = np.concatenate([np.arange(len(d)) for _, d in met])
            node, d = [np.concatenate(x) for x in zip(*met, strict=True)]
            order = _order(node)
            cuts, node = _cuts(node[order])
            # One more column where their number is odd, so that sums of rows are added in pairs.
            padded = np.zeros((len(own), h + 1 + (h + 1) % 2), states.dtype)
            padded[:, :h + 1] = seen
            moved = padded.take(place[order], axis=0)
            moved *= d[order][:, None]
            self.rows["tree"] = node, _run_sums(moved, cuts)[:, :h + 1]

    def _back(self, before, kept, keep, known, hashed, d_before, grads) -> None:
        w, h = self.w, self.shape.hidden
        _, steps, slots = before.shape
        # All that does not need the gradients of later steps is worked out for all steps at once.
        update, reset = np.split(np.stack([gates for gates, _, _ in kept]), 2, axis=1)
        new, states = np.stack([new for _, new, _ in kept]), before.transpose(1, 0, 2)
        d_u, d_x = self._buffer("d_u", steps, 3, h, slots), self._buffer("d_x", steps * slots, 3 * h)
        stays = 1 - update
        d_new = 1 - new * new
        d_new *= stays
        stays *= update
        np.subtract(states, new, out=new)
        np.multiply(new, stays, out=d_u[:, 0])
        np.multiply(d_new, reset, out=d_u[:, 2])
        np.multiply(d_u[:, 2], np.stack([u_new for _, _, u_new in kept]), out=d_u[:, 1])
        d_u[:, 1] *= 1 - reset
        d_state = np.zeros((h, slots), before.dtype)
        for t in range(steps - 1, -1, -1):
            d_u[t] *= d_state
            d_new[t] *= d_state
            stay = d_state * update[t]
            stay += w["state"] @ d_u[t].reshape(3 * h, slots)
            stay += d_before[:, t]
            stay *= keep[t]
            d_state = stay
        d_u, rows = d_u.reshape(steps, 3 * h, slots), d_x.reshape(steps, slots, 3 * h)
        rows[:, :, :2 * h] = d_u[:, :2 * h].transpose(0, 2, 1)
        rows[:, :, 2 * h:] = d_new.transpose(0, 2, 1)
        grads["state"] = (states @ d_u.transpose(0, 2, 1)).sum(axis=0)
        order = _order(known)
        cuts, ids = _cuts(known[order])
        grads["table"] = np.zeros_like(w["table"])
        grads["table"][ids] = _run_sums(d_x.take(order, axis=0), cuts)
        if hashed is not None:
            order = _order(hashed)[np.count_nonzero(hashed == 0):]
            if len(order):
                cuts, ids = _cuts(hashed[order])
                self.rows["hashed"] = ids, _run_sums(d_x.take(order, axis=0), cuts)
        self._step(grads)

    def _step(self, grads) -> None:
        """One step of Adam, of Adagrad by rows for the sparse parts, the whole gradient at most 1 long."""
        self.steps += 1
        squares = {name: np.einsum("ij,ij->i", g, g) for name, (_, g) in self.rows.items()}
        long = np.sqrt(sum(float(np.vdot(g, g)) for g in grads.values()) + sum(float(x.sum()) for x in squares.values()))
        cut = np.float32(min(1.0, 1.0 / max(long, 1e-12)))
        rate = np.float32(self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps))
        for name, g in grads.items():
            g *= cut
            mean, square, part = self.mean[name], self.square[name], self._buffer("step", *g.shape)
            np.subtract(g, mean, out=part)
            part *= np.float32(0.1)
            mean += part
            np.multiply(g, g, out=part)
            part -= square
            part *= np.float32(0.01)
            square += part
            np.sqrt(square, out=part)
            part += np.float32(1e-6)
            np.multiply(mean, rate, out=g)
            g /= part
            self.w[name] -= g
        for name, (ids, g) in self.rows.items():
            square = self.square[name].take(ids)
            square += squares[name] * (cut * cut / np.float32(g.shape[1]))
            self.square[name][ids] = square
            self.met[name][ids] += 1
            g *= (cut * np.float32(-SPARSE_RATE) / (np.sqrt(square) + np.float32(1e-6)))[:, None]
            _add_to(self.w[name], ids, g)
