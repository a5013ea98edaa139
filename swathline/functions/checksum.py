"""CRC-32C (Castagnoli), and the masked form that record files carry."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: The reflected polynomial and the constant of the mask.  Fixed values.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8


def _steps() -> np.ndarray:
    """The remainder of each byte, for steps of one byte."""
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = np.where(values & 1, (values >> 1) ^ np.uint32(POLYNOMIAL), values >> 1).astype(np.uint32)
    return values


_STEP = _steps()


def _tables(columns: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by what it makes of each bit, as a table for each byte."""
    tables = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        tables[bit // 8][(np.arange(256) >> bit % 8 & 1).astype(bool)] ^= columns[bit]
    return tables


def _apply(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    return tables[0][values & 0xFF] ^ tables[1][values >> 8 & 0xFF] ^ tables[2][values >> 16 & 0xFF] ^ tables[3][values >> 24]


@functools.cache
def _zeros(power: int) -> np.ndarray:
    """What ``2 ** power`` zero bytes make of a remainder."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    if power:
        half = _zeros(power - 1)
        return _tables(_apply(half, _apply(half, bits)))
    return _tables(_STEP[bits & 0xFF] ^ (bits >> 8))


def crc32c_of(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The checksums of ``data[at[i]:at[i + 1]]``, all rows together.

    Without its preset a remainder is linear, so rows are cut from their ends into pieces of one size (zeros in front change nothing), all
    pieces go through the byte table side by side, and each row's pieces are then folded by what the bytes after them make of a remainder.
    """
    sizes = np.diff(at)
    power = max(4, (int(sizes.max(initial=0)).bit_length() + 1) // 2)
    length = 1 << power
    pieces = -(-sizes // length)
    row = np.repeat(np.arange(len(sizes)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = at[1:][row] - (pieces[row] - number) * length
    crc = np.zeros(len(row), np.uint32)
    for position in range(length):
        place = begin + position
        byte = np.where(place >= at[:-1][row], data[np.maximum(place, 0)], 0) if len(row) else crc
        crc = _STEP[(crc ^ byte) & 0xFF] ^ (crc >> 8)
    found, tables = np.zeros(len(sizes), np.uint32), _zeros(power)
    by_number = np.argsort(number, kind="stable")
    for places in np.split(by_number, np.searchsorted(number[by_number], np.arange(1, int(pieces.max(initial=0))))):
        found[row[places]] = _apply(tables, found[row[places]]) ^ crc[places]
    preset = np.full(len(sizes), 0xFFFFFFFF, np.uint32)
    for bit in range(int(sizes.max(initial=0)).bit_length()):
        preset = np.where(sizes >> bit & 1, _apply(_zeros(bit), preset), preset)
    return found ^ preset ^ np.uint32(0xFFFFFFFF)


def crc32c(data: bytes) -> int:
    return int(crc32c_of(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0])


def mask(crc: np.ndarray) -> np.ndarray:
    crc = crc.astype(np.uint64)
    return ((crc >> np.uint64(15) | crc << np.uint64(17)) + np.uint64(MASK_DELTA)) & np.uint64(0xFFFFFFFF)


def masked(data: bytes) -> int:
    return int(mask(np.array([crc32c(data)]))[0])


@F.pandas_udf(LongType())
def masked_crc(values: pd.Series) -> pd.Series:
    """The masked checksum of each value; null stays null."""
    some = values.notna().to_numpy()
    parts = [bytes(v) for v in values[some]]
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    found = pd.Series(pd.NA, index=values.index, dtype="Int64")
    found[some] = mask(crc32c_of(np.frombuffer(b"".join(parts), np.uint8), at)).astype(np.int64)
    return found
