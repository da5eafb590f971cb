"""Plain statements of the operators' results on small inputs."""

from __future__ import annotations

import numpy as np


def component_of(nodes, links):
    """Smallest node reachable, by repeated relaxation."""
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def cosine(a, b):
    a, b = np.asarray(a, dtype=float), np.asarray(b, dtype=float)
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))
