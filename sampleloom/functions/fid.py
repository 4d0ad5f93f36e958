"""Feature ids: slot and signature packed into one BIGINT, and expressions over lists of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sampleloom.functions.base import ColumnLike, col_of

# Fixed values of the two id layouts.
V1_SIGNATURE_BITS = 54
V1_SLOTS = 1024
V2_SIGNATURE_BITS = 48
V2_SLOTS = 32768


def _mask(bits: int) -> Column:
    return F.lit((1 << bits) - 1).cast("bigint")


def _bits(version: int) -> int:
    if version not in (1, 2):
        raise ValueError(f"fid version must be 1 or 2, got {version}")
    return V1_SIGNATURE_BITS if version == 1 else V2_SIGNATURE_BITS


def _slot_limit(version: int) -> int:
    return V1_SLOTS if version == 1 else V2_SLOTS


def make_fid(slot: ColumnLike | int, signature: ColumnLike, version: int = 2) -> Column:
    """Pack ``slot`` and ``signature``; signature bits beyond the layout are dropped."""
    bits = _bits(version)
    if isinstance(slot, int):
        if not 0 <= slot < _slot_limit(version):
            raise ValueError(f"slot {slot} does not fit fid v{version}")
        slot = F.lit(slot)
    return F.shiftleft(col_of(slot).cast("bigint"), bits).bitwiseOR(
        col_of(signature).cast("bigint").bitwiseAND(_mask(bits)))


def slot_of(fid: ColumnLike, version: int = 2) -> Column:
    """Slot number; the shift is unsigned because v1 slots from 512 on make the BIGINT negative."""
    shifted = F.shiftrightunsigned(col_of(fid), _bits(version))
    return shifted.bitwiseAND(F.lit(_slot_limit(version) - 1).cast("bigint")).cast("int")


def signature_of(fid: ColumnLike, version: int = 2) -> Column:
    return col_of(fid).bitwiseAND(_mask(_bits(version)))


def v1_to_v2(fid: ColumnLike) -> Column:
    return make_fid(slot_of(fid, 1), fid, 2)


def switch_slot(fids: ColumnLike, slot: int, version: int = 2, compat: bool = False) -> Column:
    """Move every id of the list to ``slot``. ``compat`` keeps one bit more of the old id, so the
    lowest bit of the old slot survives."""
    bits = _bits(version)
    keep = _mask(bits + 1 if compat else bits)
    head = F.shiftleft(F.lit(slot).cast("bigint"), bits)
    return F.transform(col_of(fids), lambda f: head.bitwiseOR(f.bitwiseAND(keep)))


def slots_of(fids: ColumnLike, version: int = 2) -> Column:
    """Distinct slots of a list of ids."""
    return F.array_distinct(F.transform(col_of(fids), lambda f: slot_of(f, version)))


def extract_fid(value: ColumnLike, slot: int) -> Column:
    """Hash an integer into the signature space of ``slot`` (stable inside these tables)."""
    return make_fid(slot, F.xxhash64(col_of(value)), 2)


def extract_fid_md5(value: ColumnLike, slot: int) -> Column:
    """As :func:`extract_fid` with a portable hash: 48 bits of the md5 of the decimal text."""
    head = F.substring(F.md5(col_of(value).cast("string").cast("binary")), 1, 12)
    return make_fid(slot, F.conv(head, 16, 10).cast("bigint"), 2)


def feature_hash(value: ColumnLike, name: str, slot: int, portable: bool = False) -> Column:
    """Id of the text ``value-name``, hashed over the whole string."""
    text = F.concat(col_of(value).cast("string"), F.lit(f"-{name}"))
    if portable:
        head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10)
        return make_fid(slot, head.cast("bigint"), 2)
    return make_fid(slot, F.xxhash64(text), 2)


def float_bucket(x: ColumnLike) -> Column:
    """``int(log2(|x| + 1))``."""
    return F.floor(F.log2(F.abs(col_of(x)) + F.lit(1.0))).cast("bigint")


def fid_mask(fids: ColumnLike, fid: int | Column) -> Column:
    """1.0 where the list holds ``fid``, else 0.0."""
    return F.coalesce(F.array_contains(col_of(fids), fid), F.lit(False)).cast("double")


def seq_mask(size: ColumnLike, max_len: int) -> Column:
    """1 for the first ``min(size, max_len)`` positions, then 0."""
    return F.transform(F.sequence(F.lit(0), F.lit(max_len - 1)),
                       lambda i: F.when(i < col_of(size), 1).otherwise(0))


def _to_signed(unsigned: Column) -> Column:
    """Decimal in [0, 2^64) to the BIGINT with the same bits."""
    wrap = F.lit(str(1 << 64)).cast("decimal(20,0)")
    half = F.lit(str(1 << 63)).cast("decimal(20,0)")
    return F.when(unsigned >= half, unsigned - wrap).otherwise(unsigned).cast("bigint")


def fid_mix(a: ColumnLike, b: ColumnLike) -> Column:
    """Fold the 128-bit unsigned product of two ids: high half XOR low half.

    Built from 32-bit halves in DECIMAL, so no BIGINT product can overflow.
    """
    low32 = F.lit((1 << 32) - 1).cast("bigint")
    two32 = F.lit(1 << 32).cast("decimal(20,0)")

    def halves(x: Column) -> tuple[Column, Column]:
        return (F.shiftrightunsigned(x, 32).cast("decimal(10,0)"),
                x.bitwiseAND(low32).cast("decimal(10,0)"))

    def carry(x: Column) -> Column:
        return F.floor(x / two32).cast("decimal(21,0)")

    (ah, al), (bh, bl) = halves(col_of(a)), halves(col_of(b))
    p0 = al * bl
    mid = (ah * bl) + (al * bh) + carry(p0)
    low = ((mid % two32) * two32 + (p0 % two32)).cast("decimal(20,0)")
    high = ((ah * bh) + carry(mid)).cast("decimal(20,0)")
    return _to_signed(high).bitwiseXOR(_to_signed(low))


def feature_combine(left: ColumnLike, right: ColumnLike, slot: int) -> Column:
    """Ids of all pairs of two per-row id lists, placed in ``slot``."""
    return F.flatten(F.transform(col_of(left), lambda x: F.transform(
        col_of(right), lambda y: make_fid(slot, fid_mix(x, y), 2))))


def java_hash(text: ColumnLike) -> Column:
    """31·h + byte over the UTF-8 bytes with signed bytes and 32-bit wrap, as INT."""
    digits = F.hex(F.encode(col_of(text), "UTF-8"))
    n = F.length(digits) / F.lit(2)
    word = F.lit(0xFFFFFFFF).cast("bigint")

    def byte(i: Column) -> Column:
        b = F.conv(F.substring(digits, i * 2 - 1, F.lit(2)), 16, 10).cast("bigint")
        return F.when(b >= 128, b - 256).otherwise(b)

    wrapped = F.aggregate(F.sequence(F.lit(1), n.cast("int")), F.lit(0).cast("bigint"),
                          lambda h, i: (h * 31 + byte(i)).bitwiseAND(word))
    signed = F.when(wrapped >= (1 << 31), wrapped - (1 << 32)).otherwise(wrapped)
    return F.when(F.length(digits) == 0, F.lit(0)).otherwise(signed.cast("int"))


def data_source_key(name: ColumnLike) -> Column:
    """Flow key of a data source: its 32-bit hash moved up by one byte, kept to 32 unsigned bits."""
    word = F.lit(0xFFFFFFFF).cast("bigint")
    return F.shiftleft(java_hash(name).cast("bigint"), 8).bitwiseAND(word)
