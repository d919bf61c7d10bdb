"""Plain-Python statements of the model operators for small inputs."""

from __future__ import annotations

import math

import numpy as np


def blobs(seed=0, sizes=(40, 30, 25), spread=0.5, outliers=8, copies=6):
    rng = np.random.default_rng(seed)
    centres = np.array([[0, 0, 0], [4, 4, 0], [0, 5, 5]], dtype=float)
    parts = [rng.normal(c, spread, (n, 3)) for c, n in zip(centres, sizes)]
    parts.append(rng.uniform(-4, 9, (outliers, 3)))
    x = np.vstack(parts)
    x = np.vstack([x, np.repeat(x[:1], copies, axis=0)])
    return np.round(x, 4)


def distances(a, b):
    return np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2))


def dbscan(x, ids, eps, min_samples):
    near = distances(x, x) <= eps
    core = near.sum(axis=1) >= min_samples
    label = {i: ids[i] for i in range(len(x)) if core[i]}
    changed = True
    while changed:
        changed = False
        for i in label:
            for j in label:
                if near[i, j] and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    out = []
    for i in range(len(x)):
        if core[i]:
            out.append(label[i])
        else:
            close = [label[j] for j in label if near[i, j]]
            out.append(min(close) if close else -1)
    return out


def silhouettes(x, labels):
    d = distances(x, x)
    labels = np.asarray(labels)
    out = []
    for i in range(len(x)):
        own = labels == labels[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels.tolist()) if c != labels[i])
        out.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return out


def mean_shift(x, bandwidth, cluster_all):
    modes = {}
    for start in np.unique(x, axis=0):
        at = start
        for _ in range(301):
            inside = np.sqrt(((x - at) ** 2).sum(axis=1)) <= bandwidth
            if not inside.any():
                break
            mean = np.round(x[inside].mean(axis=0), 12)
            moved = math.dist(mean, at)
            at = mean
            if moved <= 1e-3 * bandwidth:
                key = tuple(at)
                modes[key] = max(modes.get(key, 0), int(inside.sum()))
                break
    order = sorted(modes.items(), key=lambda m: (m[1], m[0]), reverse=True)
    kept = []
    for position, _ in order:
        if all(math.dist(position, k) > bandwidth for k in kept):
            kept.append(position)
    d = distances(x, np.array(kept))
    labels = d.argmin(axis=1)
    if not cluster_all:
        labels = np.where(d.min(axis=1) <= bandwidth, labels, -1)
    return labels.tolist()


def mixture(x, start, k, covariance, tolerance=1e-3, rounds=100):
    """Expectation maximisation on rows, from given labels."""
    n, d = x.shape

    def estimate(r):
        weight = r.sum(axis=0)
        mean = r.T @ x / weight[:, None]
        cov = np.zeros((k, d, d))
        for c in range(k):
            away = x - mean[c]
            cov[c] = (r[:, c, None] * away).T @ away / weight[c]
        if covariance == "tied":
            cov[:] = (cov * weight[:, None, None]).sum(axis=0) / n
        elif covariance == "diag":
            cov = np.array([np.diag(np.diag(c)) for c in cov])
        elif covariance == "spherical":
            cov = np.array([np.eye(d) * np.diag(c).mean() for c in cov])
        return weight / n, mean, cov + 1e-6 * np.eye(d)

    def expect(model):
        share, mean, cov = model
        dens = np.zeros((n, k))
        for c in range(k):
            away = x - mean[c]
            square = np.einsum("ni,ij,nj->n", away, np.linalg.inv(cov[c]), away)
            scale = np.sqrt((2 * np.pi) ** d * np.linalg.det(cov[c]))
            dens[:, c] = share[c] * np.exp(-square / 2) / scale
        total = dens.sum(axis=1)
        return dens / total[:, None], np.log(total).mean()

    model, before = estimate(np.eye(k)[np.asarray(start)]), -np.inf
    for _ in range(rounds):
        r, likelihood = expect(model)
        model = estimate(r)
        if abs(likelihood - before) < tolerance:
            break
        before = likelihood
    return expect(model)[0].argmax(axis=1).tolist()
