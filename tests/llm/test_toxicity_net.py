"""The recurrent network against plain loops and finite differences."""

import numpy as np

from clickscope.llm import toxicity as T

TEXTS = ["some words here, and some more of them again", "", "one", " ".join(f"w{i % 37}" for i in range(130))]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _plain(net, x, ids):
    """Logit of one window, word by word."""
    h, states = T.HIDDEN, {}
    for side in "fb":
        state = np.zeros(h)
        for t in range(T.WINDOW) if side == "f" else reversed(range(T.WINDOW)):
            a, c = x[ids[t]] @ net.p[f"{side}_x"] + net.p[f"{side}_b"], state @ net.p[f"{side}_h"]
            z, r = _sigmoid(a[:h] + c[:h]), _sigmoid(a[h:2 * h] + c[h:2 * h])
            n = np.tanh(a[2 * h:] + r * c[2 * h:])
            state = (1 - z) * n + z * state
            states[side, t] = state
    some = [np.concatenate([states["f", t], states["b", t]]) for t in range(T.WINDOW) if ids[t]]
    if not some:
        return float(net.p["out_b"][0])
    e = np.exp([s @ net.p["att"] for s in some])
    return float(sum(w * s for w, s in zip(e / e.sum(), some)) @ net.p["out"] + net.p["out_b"][0])


def test_windows_hold_every_passage():
    words, ids, owner = T.windows_of(TEXTS)
    assert owner.tolist() == [0, 1, 2, 3, 3, 3, 3, 3] and (ids[1] == 0).all() and (ids[2] > 0).sum() == 1
    flat = ids[3][:T.STRIDE].tolist()
    for row in ids[4:]:
        flat += row[:T.STRIDE].tolist()
    flat += ids[-1][T.STRIDE:].tolist()
    assert len([x for x in flat if x]) == 130
    assert all((ids[i][T.STRIDE:] == ids[i + 1][:T.STRIDE]).all() for i in range(3, 7))


def test_logits_equal_plain_loops():
    net = T.Net(1)
    words, ids, _ = T.windows_of(TEXTS)
    want = [_plain(net, net.inputs(words), row) for row in ids]
    assert np.allclose(net.logits(words, ids), want, atol=1e-4) and np.allclose(net.forward(words, ids), want, atol=1e-4)


def test_gradients_equal_finite_differences():
    net, rng = T.Net(2), np.random.default_rng(0)
    words, ids, _ = T.windows_of(TEXTS)
    label, weight = np.array([1, 0, 1, 0, 1, 0, 1, 0], np.float32), np.linspace(0.5, 2, 8).astype(np.float32)

    def loss():
        p = _sigmoid(np.array([_plain(net, net.inputs(words).astype(float), row) for row in ids]))
        return -(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).mean()

    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    grads = net.gradients(words, ids, label, weight)
    for name, g in grads.items():
        flat, values = np.asarray(g).reshape(-1), net.p[name].reshape(-1)
        big = np.argsort(-np.abs(flat))[:3]
        for i in {*big.tolist(), int(rng.integers(len(flat)))}:
            was, at = values[i], []
            for d in (1e-4, -1e-4):
                values[i] = was + d
                at.append(loss())
            values[i] = was
            assert abs((at[0] - at[1]) / 2e-4 - flat[i]) < 1e-4 + 0.01 * abs(flat[i]), (name, i)
