"""A small causal self-attention language model in numpy.

One layer, one head, a learned bias per distance. The output is the chance of a subword's class, times
the subword's corpus-wide share of its class; frequent subwords have a class of their own. A class's
chance is a softmax over groups of classes times one over the classes of its group: exact and summing to
1, and each token needs the logits of one group only.

A token sees its own block of BLOCK tokens, up to itself, and the block before: context windows of two
blocks overlap by one and score each token once. Keys and values do not depend on the place in the
window, so the trained model keeps them as tables per subword.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 16
WIDTH = 16
CLASSES, GROUPS = 256, 16
MEMBERS = CLASSES // GROUPS
#: Classes that hold one frequent subword each.
SINGLE = 224
STEPS, BATCH, RATE = 250, 64, 0.01
#: Rate of the steps over the whole corpus, and the blocks whose gradients are held at once: few, so that they stay in a core's cache.
WHOLE_RATE, GRADIENT_BLOCKS = 0.02, 256
#: Blocks that are scored at once.
CHUNK_BLOCKS = 256
LOG10 = float(np.log(10.0))


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of every subword, and its log10 share of the class, from smoothed corpus counts."""
    order = np.argsort(-counts, kind="stable")
    of, mass = np.zeros(len(counts), np.int64), counts + 0.5
    single = min(SINGLE, len(counts))
    of[order[:single]] = np.arange(single)
    rest = order[single:]
    if len(rest):
        share = np.cumsum(mass[rest]) / mass[rest].sum()
        of[rest] = np.minimum(single + (share * (CLASSES - single)).astype(np.int64), CLASSES - 1)
    total = np.bincount(of, mass, CLASSES)
    return of, np.log10(mass / total[of])


#: Scores within this range need no shift before exp in 32 bits.
SAFE = 60.0


def _exp(a: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """exp of every row in place, less the row's maximum (returned) where some score lies out of range, and the rows' sums."""
    most = None
    if a.size and not (a.max() < SAFE and a.min() > -SAFE):
        most = a.max(-1, keepdims=True)
        a -= most
    np.exp(a, out=a)
    return most, a @ np.ones(a.shape[-1], a.dtype)


def _weights(w: np.ndarray, bias: np.ndarray, open_: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Unscaled attention weights of (blocks, BLOCK, 2 * BLOCK) scores, in place, and their sums. A token sees itself,
    so a row's maximum is finite."""
    w += bias
    if not (w.max() < SAFE and w[:, np.arange(BLOCK), BLOCK + np.arange(BLOCK)].min() > -SAFE):
        seen = np.where(open_, w, -np.inf)
        seen[first, :, :BLOCK] = -np.inf
        w -= seen.max(-1, keepdims=True)
        np.minimum(w, SAFE, out=w)
    np.exp(w, out=w)
    w *= open_
    w[first, :, :BLOCK] = 0
    return w @ np.ones(2 * BLOCK, w.dtype)


def log_chances(p: dict[str, np.ndarray], h: np.ndarray, want: np.ndarray, grads: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural logs of the chances of classes ``want`` after states ``h``, 0 where the class is -1. With ``grads``, the
    gradients of minus their sum are added there, and those by ``h`` are returned, too. Rows go group by group, so
    that the logits of the groups and of one group's classes are one product."""
    group = (want // MEMBERS).astype(np.int8)
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group.take(order), np.arange(GROUPS + 1))
    order, edges = order[edges[0] :], (edges - edges[0]).tolist()
    states, wanted = h.take(order, 0), want.take(order)
    of_groups, of_classes = np.broadcast_to(p["g"], (GROUPS, WIDTH, GROUPS)), p["c"].reshape(WIDTH, GROUPS, MEMBERS).transpose(1, 0, 2)
    both = np.concatenate([of_groups, of_classes], axis=2)
    bias = np.concatenate([np.broadcast_to(p["gb"], (GROUPS, GROUPS)), p["b"].reshape(GROUPS, MEMBERS)], axis=1)
    spans = [(n, slice(lo, hi)) for n, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if lo < hi]
    a = np.empty((len(order), GROUPS + MEMBERS), both.dtype)
    for n, its in spans:
        np.matmul(states[its], both[n], out=a[its])
        a[its] += bias[n]
    # the groups' logits and the classes' are rows of their own, of one length
    rows, flat = a.reshape(-1, MEMBERS), a.reshape(-1)
    start = np.arange(len(order)) * (GROUPS + MEMBERS)
    at_group, at_class = start + wanted // MEMBERS, start + (GROUPS + wanted % MEMBERS)
    got = flat.take(at_group) + flat.take(at_class)
    most, total = _exp(rows)
    logs_of = np.log(total)
    if most is not None:
        logs_of += most[:, 0]
    got -= logs_of[::2]
    got -= logs_of[1::2]
    logs = np.zeros(len(h), got.dtype)
    logs[order] = got
    if grads is None:
        return logs, None
    rows *= (1 / total)[:, None]
    flat[at_group] -= 1
    flat[at_class] -= 1
    dh = np.empty_like(states)
    for n, its in spans:
        np.matmul(a[its], both[n].T, out=dh[its])
        grad, sums = states[its].T @ a[its], np.ones(its.stop - its.start, a.dtype) @ a[its]
        classes_ = slice(n * MEMBERS, (n + 1) * MEMBERS)
        grads["g"] += grad[:, :GROUPS]
        grads["c"][:, classes_] += grad[:, GROUPS:]
        grads["gb"] += sums[:GROUPS]
        grads["b"][classes_] += sums[GROUPS:]
    back = np.zeros_like(h)
    back[order] = dh
    return logs, back


def _windows(t: np.ndarray) -> np.ndarray:
    """Every block of the rows ``t`` after the first with the one before it, as a view: (blocks, 2 * BLOCK, columns)."""
    row, item = t.strides
    return np.lib.stride_tricks.as_strided(t, (len(t) // BLOCK - 1, 2 * BLOCK, t.shape[1]), (BLOCK * row, row, item), writeable=False)


class Attention:
    """Parameters, training by hand-written gradients, and scoring.

    ``train`` starts the parameters off on sampled windows, ``descend`` goes on with sums over all blocks.
    """

    def __init__(self, counts: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.of, self.share = classes(counts)
        mass = np.bincount(self.of, counts + 0.5, CLASSES)
        near = lambda *shape: rng.normal(0, 0.2, shape)
        groups = mass.reshape(GROUPS, MEMBERS).sum(1)
        # a subword that no training text has adds nothing as context
        self.p = {
            "e": near(len(counts), WIDTH) * (counts > 0)[:, None],
            "q": near(WIDTH, WIDTH),
            "k": near(WIDTH, WIDTH),
            "v": near(WIDTH, WIDTH),
            "c": near(WIDTH, CLASSES) * 0.1,
            "d": np.zeros(2 * BLOCK),
            "b": np.log(np.maximum(mass, 1e-9) / np.repeat(np.maximum(groups, 1e-9), MEMBERS)),
            "g": near(WIDTH, GROUPS) * 0.1,
            "gb": np.log(np.maximum(groups, 1e-9) / groups.sum()),
        }

    def loss(self, ids: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of the classes over windows of 2 * BLOCK tokens, and its gradients.

        ``target``: the next subword of every token, -1 where there is none.
        """
        p, n = self.p, ids.shape[1]
        far = np.arange(n)[:, None] - np.arange(n)[None, :]
        x = p["e"][ids]
        q, k, v = x @ p["q"], x @ p["k"], x @ p["v"]
        a = q @ k.transpose(0, 2, 1) / np.sqrt(WIDTH) + p["d"][np.abs(far)]
        a = np.where(far >= 0, a, -1e9)
        w = np.exp(a - a.max(-1, keepdims=True))
        w /= w.sum(-1, keepdims=True)
        h = x + w @ v
        count = max(1, (target >= 0).sum())
        grads = {name: np.zeros_like(value) for name, value in p.items()}
        logs, back = log_chances(p, h.reshape(-1, WIDTH), np.append(self.of, -1)[target.ravel()], grads)
        for name in ("c", "b", "g", "gb"):
            grads[name] /= count
        dh = back.reshape(h.shape) / count
        dw = dh @ v.transpose(0, 2, 1)
        da = w * (dw - (dw * w).sum(-1, keepdims=True))
        dq, dk, dv = da @ k / np.sqrt(WIDTH), da.transpose(0, 2, 1) @ q / np.sqrt(WIDTH), w.transpose(0, 2, 1) @ dh
        dx = dh + dq @ p["q"].T + dk @ p["k"].T + dv @ p["v"].T
        np.add.at(grads["e"], ids, dx)
        flat = lambda t: t.reshape(-1, t.shape[-1])
        grads |= {
            "q": flat(x).T @ flat(dq),
            "k": flat(x).T @ flat(dk),
            "v": flat(x).T @ flat(dv),
            "d": np.bincount(np.abs(far).ravel(), np.where(far >= 0, da.sum(0), 0).ravel(), 2 * BLOCK),
        }
        return float(-logs.sum() / count), grads

    def train(self, ids: np.ndarray, target: np.ndarray, steps: int = STEPS, seed: int = 2) -> list[float]:
        """Adam over random batches of the windows; the losses on the way."""
        losses: list[float] = []
        if not len(ids):
            return losses
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(ids), min(BATCH, len(ids)))
            value, grads = self.loss(ids[pick], target[pick])
            losses.append(value)
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.98 * s[k] + 0.02 * g * g
                self.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.98**step)) + 1e-8)
        return losses

    def packed(self) -> np.ndarray:
        """All parameters in rows of WIDTH, the embeddings first."""
        return pack(self.p)

    def descend(self, sums: Iterator[np.ndarray | None], steps: int) -> list[float]:
        """Adam over sums of gradients as ``block_sums`` packs them, a step each; the mean losses on the way.

        ``sums`` is asked for the next step only after the parameters have moved. None moves nothing.
        """
        losses: list[float] = []
        m = s = 0.0
        for step in range(1, steps + 1):
            got = next(sums)
            if got is None or not got[-1, 1]:
                continue
            losses.append(float(got[-1, 0] / got[-1, 1]))
            g = got[:-1] / got[-1, 1]
            m, s = 0.9 * m + 0.1 * g, 0.98 * s + 0.02 * g * g
            n = len(losses)
            rate = WHOLE_RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            moved = self.packed() - rate * (m / (1 - 0.9**n)) / (np.sqrt(s / (1 - 0.98**n)) + 1e-8)
            self.p = unpack(moved, self.p)
        return losses

    def tables(self) -> Tables:
        return Tables(self)


def pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([np.append(v.ravel(), np.zeros(-v.size % WIDTH)).reshape(-1, WIDTH) for v in p.values()])


def unpack(rows: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, v in like.items():
        n = -(-v.size // WIDTH)
        out[name] = rows[at : at + n].ravel()[: v.size].reshape(v.shape)
        at += n
    return out


def block_sums(p: dict[str, np.ndarray], of: np.ndarray, ids: np.ndarray, target: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``Sums`` of the rows of one call."""
    sums = Sums(p, of)
    sums.add(ids, target, first)
    return sums.packed()


class Sums:
    """Sums of the gradients over rows of BLOCK tokens with the contexts of ``Tables.log10``."""

    def __init__(self, p: dict[str, np.ndarray], of: np.ndarray):
        kind = p["e"].dtype
        far = BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)[None, :]
        self.away = np.clip(far, 0, 2 * BLOCK - 1)
        self.open = (far >= 0).astype(kind)
        self.bias = np.where(far >= 0, p["d"][self.away], 0).astype(kind)
        self.scale = kind.type(1 / np.sqrt(WIDTH))
        self.p, self.of = p, np.append(of, -1)  # a target of -1 has class -1
        self.ways = {"q": p["q"] * self.scale, "k": p["k"], "v": p["v"]}
        self.grads = {name: np.zeros(v.shape) for name, v in p.items()}
        self.loss, self.count = 0.0, 0

    def add(self, ids: np.ndarray, target: np.ndarray, first: np.ndarray) -> None:
        p, ways, grads, kind = self.p, self.ways, self.grads, self.bias.dtype
        turn, ones = np.concatenate(list(ways.values()), axis=1), np.ones(max(WIDTH, GRADIENT_BLOCKS), kind)
        dy = np.empty((GRADIENT_BLOCKS + 1, BLOCK, WIDTH), kind)
        dx = np.zeros((len(ids) + 1, BLOCK, WIDTH), kind)  # the first block stands for the one before the very first
        self.count += int((target >= 0).sum())
        for at in range(0, len(ids), GRADIENT_BLOCKS):
            upto = min(len(ids), at + GRADIENT_BLOCKS)
            n = upto - at
            # the blocks and the one before them; before the very first there is none, and a text begins with it
            x = p["e"].take(np.concatenate([ids[max(0, at - 1)][None], ids[at:upto]]).ravel(), 0)
            y = x @ turn
            q, k, v = y[BLOCK:, :WIDTH].reshape(n, BLOCK, WIDTH), _windows(y[:, WIDTH : 2 * WIDTH]), _windows(y[:, 2 * WIDTH :])
            w = np.matmul(q, k.transpose(0, 2, 1))
            part = 1 / _weights(w, self.bias, self.open, first[at:upto])[..., None]
            seen = np.matmul(w, v)
            seen *= part
            h = (x[BLOCK:].reshape(seen.shape) + seen).reshape(-1, WIDTH)
            logs, dh = log_chances(p, h, self.of.take(target[at:upto].ravel(), mode="wrap"), grads)
            self.loss -= float(logs.sum(dtype=float))
            dh = dh.reshape(seen.shape)
            ds = dh * part  # w is left without its division by the sums
            dw = np.matmul(ds, v.transpose(0, 2, 1))
            seen *= ds
            dw -= (seen @ ones[:WIDTH])[..., None]
            dw *= w  # now the gradients of the scores
            got = dx[at : upto + 1].reshape(-1, WIDTH)
            got[BLOCK:] += dh.reshape(-1, WIDTH)
            own = x[BLOCK:]
            dq = np.matmul(dw, k).reshape(-1, WIDTH)
            grads["q"] += own.T @ dq
            got[BLOCK:] += dq @ ways["q"].T
            # a block's keys and values have gradients from itself and from the next one
            for name, left, right in (("k", dw, q), ("v", w, ds)):
                both = np.matmul(left.transpose(0, 2, 1), right)
                dy[0] = 0
                dy[1 : n + 1] = both[:, BLOCK:]
                dy[:n] += both[:, :BLOCK]
                rows = dy[: n + 1].reshape(-1, WIDTH)
                grads[name] += x.T @ rows
                got += rows @ ways[name].T
            grads["d"] += np.bincount(self.away.ravel(), ones[:n] @ dw.reshape(n, -1), 2 * BLOCK)
        _add_rows(grads["e"], ids.ravel(), dx[1:].reshape(-1, WIDTH))

    def packed(self) -> np.ndarray:
        """The sums, packed like the parameters; one more row holds the sum of the cross-entropies and the number of targets."""
        end = np.zeros((1, WIDTH))
        end[0, :2] = self.loss, self.count
        return np.concatenate([pack(self.grads | {"q": self.grads["q"] * self.scale}), end])


def _add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Adds every row to row ``at`` of ``to``."""
    place = at.astype(np.uint16) if len(to) <= 1 << 16 else at  # 16 bits are sorted by their digits
    order = np.argsort(place, kind="stable")
    place = place.take(order)
    starts = np.flatnonzero(np.append(True, place[1:] != place[:-1])[: len(place)])
    if len(starts):
        to[place[starts]] += np.add.reduceat(rows.take(order, 0), starts, axis=0, dtype=to.dtype)


class Tables:
    """The trained model as lookups per subword, for scoring."""

    def __init__(self, model: Attention):
        p = model.p
        # a target of -1 has class -1 and share 0
        self.of, self.share = np.append(model.of, -1), np.append(model.share, 0.0)
        one = np.float32
        #: Query, key, value and embedding of every subword, in one row.
        self.rows = np.concatenate([p["e"] @ p["q"] / np.sqrt(WIDTH), p["e"] @ p["k"], p["e"] @ p["v"], p["e"]], axis=1).astype(one)
        self.p = {name: p[name].astype(one) for name in ("c", "b", "g", "gb")}
        far = BLOCK + np.arange(BLOCK)[:, None] - np.arange(2 * BLOCK)[None, :]
        self.open = (far >= 0).astype(one)
        self.bias = np.where(far >= 0, p["d"][np.clip(far, 0, 2 * BLOCK - 1)], 0).astype(one)

    def log10(self, ids: np.ndarray, target: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 chance of every target (0 where it is -1), for rows of BLOCK tokens.

        The block before a row is its context, unless ``first`` says that a text begins with it.
        """
        out = np.zeros(ids.shape)
        for at in range(0, len(ids), CHUNK_BLOCKS):
            upto = min(len(ids), at + CHUNK_BLOCKS)
            y = self.rows.take(np.concatenate([ids[max(0, at - 1)][None], ids[at:upto]]).ravel(), 0)
            q, k, v, x = (y[:, n * WIDTH : (n + 1) * WIDTH] for n in range(4))
            w = np.matmul(q[BLOCK:].reshape(-1, BLOCK, WIDTH), _windows(k).transpose(0, 2, 1))
            total = _weights(w, self.bias, self.open, first[at:upto])
            h = np.matmul(w, _windows(v))
            h /= total[..., None]
            h += x[BLOCK:].reshape(h.shape)
            goal = target[at:upto].ravel()
            logs, _ = log_chances(self.p, h.reshape(-1, WIDTH), self.of.take(goal, mode="wrap"))
            out[at:upto] = (logs / LOG10 + self.share.take(goal, mode="wrap")).reshape(-1, BLOCK)
        return out


def rows_of(sequences: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets) of several texts as rows of BLOCK tokens: ids, targets, first, and the texts' first rows."""
    sizes = [-(-len(x) // BLOCK) for x, _ in sequences]
    starts = np.cumsum([0, *sizes])
    ids, target = np.zeros(starts[-1] * BLOCK, np.int64), np.full(starts[-1] * BLOCK, -1, np.int64)
    for (x, y), at in zip(sequences, (starts[:-1] * BLOCK).tolist(), strict=True):
        ids[at : at + len(x)] = x
        target[at : at + len(y)] = y
    first = np.zeros(starts[-1], np.bool_)
    first[starts[:-1]] = True
    return ids.reshape(-1, BLOCK), target.reshape(-1, BLOCK), first, starts[:-1]
