"""DartMinHash: signatures of weighted sets by hashed darts.

Every element owns a strip of the plane of weight and time, and hashed darts land on it as a Poisson process of
unit intensity: the same darts in every set that holds the element. A set throws the darts that fall below its
elements' weights and before a time T; each dart belongs to one of K coordinates, and the earliest dart of a
coordinate is its signature. Two sets agree on a coordinate with probability equal to their weighted Jaccard
similarity. T is chosen so that a set of any size throws about K (ln K + 3) darts; sets with a coordinate that
no dart has hit throw on to twice the time.
"""

from __future__ import annotations

import numpy as np

from .text import mix, ragged

_STRIP = np.uint64(0xD1B54A32D192ED03)
_TIME, _PLACE, _ALL = 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7, (1 << 64) - 1


def _throw(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, horizon: np.ndarray, coordinates: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts before horizon[owner]: their cell (owner * K + coordinate), time and name."""
    strips = np.ceil(weight).astype(np.int64)
    if (strips == 1).all():
        row, strip, cover = np.arange(len(element)), np.zeros(len(element), np.uint64), weight
    else:
        row = np.repeat(np.arange(len(element)), strips)
        strip = ragged(np.zeros(len(element), np.int64), strips)
        cover = np.minimum(1.0, weight[row] - strip)
        strip = strip.astype(np.uint64)
    seed, owner = mix(element[row] + strip * _STRIP), owner[row]
    time, end = np.zeros(len(row)), horizon[owner]
    cells, times, names = [], [], []
    n = 0
    while len(seed):
        n += 1
        time = time - np.log(((mix(seed + np.uint64(n * _TIME & _ALL)) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))
        live = time < end
        seed, owner, time, end, cover = (x[live] for x in (seed, owner, time, end, cover))
        name = mix(seed ^ np.uint64(n * _PLACE & _ALL))
        below = (name & np.uint64(0xFFFFFFFF)).astype(np.float64) / (1 << 32) < cover
        at = ((name >> np.uint64(32)) % np.uint64(coordinates)).astype(np.int64)
        cells.append((owner * coordinates + at)[below])
        times.append(time[below])
        names.append(name[below])
    return np.concatenate(cells), np.concatenate(times), np.concatenate(names)


def signatures(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, sets: int, coordinates: int) -> np.ndarray:
    """Signatures (sets x coordinates) of sets given as rows (element, weight, owner), sorted by owner.

    Repeated rows of an element count once, at its largest weight: its darts are the same ones. Sets without
    weight have the signature 0 everywhere.
    """
    out = np.zeros((sets, coordinates), np.uint64)
    mass = np.bincount(owner, weight, minlength=sets)
    todo = mass > 0
    reach = np.full(sets, np.log(coordinates) + 3.0)
    while todo.any():
        use = todo[owner]
        horizon = np.where(todo, coordinates * reach / np.maximum(mass, 1e-300), 0.0)
        cell, time, name = _throw(element[use], weight[use], owner[use], horizon, coordinates)
        first = np.full(sets * coordinates, np.inf)
        np.minimum.at(first, cell, time)
        won = time == first[cell]
        flat = np.zeros(sets * coordinates, np.uint64)
        flat[cell[won]] = name[won]
        filled = np.isfinite(first).reshape(sets, coordinates).all(axis=1) & todo
        out[filled] = flat.reshape(sets, coordinates)[filled]
        todo &= ~filled
        reach *= 2
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` coordinates."""
    sets, coordinates = signature.shape
    count = coordinates // rows
    key = np.zeros((sets, count), np.uint64)
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[:, r : count * rows : rows])
    return mix(key + np.arange(count, dtype=np.uint64) * _STRIP)
