"""MPEG transport streams as a column: packets of 188 bytes with program tables, elementary packets and timestamps.

`mux` cuts a payload into access units (one PES packet each), gives every unit a presentation time stamp and every
`GOP`-th unit a random-access point, before which it repeats the program tables (PAT and PMT).

`demux` reads any stream of whole packets: it reassembles table sections over packets, checks their CRCs, walks the programs
of the PAT and the streams of the PMT past their descriptors, and takes the wanted stream's packets. Null packets, other
streams, packets with an adaptation field alone and a packet that is sent twice are passed over; a continuity counter may
jump only where the discontinuity flag says so. PES packets may lack a length (they end where the next begins), a time stamp
or the optional header. Anything else that is damaged raises StreamError. Both work on whole payloads in numpy, linear in
their size. An empty payload is a stream of tables only; null counts as empty.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialise
from .text import buffers, ranges, slices

PACKET = 188
BODY = 184
UNIT_BYTES = 16 * BODY - 14 - 8  # payload of a full access unit: a PES header and a PCR field fill up the first packet
GOP = 8  # units from one random-access point to the next
CLOCK = 90_000
UNIT_TICKS = CLOCK // 25
PMT_PID, ES_PID, PROGRAM, STREAM_TYPE, STREAM_ID = 0x1000, 0x0100, 1, 0x06, 0xBD
NULL_PID = 0x1FFF
#: Ids of elementary streams whose packets have no optional header.
BARE_IDS = [0xBC, 0xBE, 0xBF, 0xF0, 0xF1, 0xF2, 0xF8, 0xFF]
PAD = 64


class StreamError(ValueError):
    """The bytes aren't a whole transport stream: bad sync, CRC, continuity, headers or lengths."""


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = ((c << 1) ^ 0x04C11DB7) & 0xFFFFFFFF if c & 0x80000000 else (c << 1) & 0xFFFFFFFF
        table.append(c)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    """CRC-32/MPEG-2, which ends program tables."""
    c = 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ _CRC[(c >> 24) ^ b]
    return c


def _section(table_id: int, key: int, body: bytes) -> bytes:
    head = bytes([table_id, 0xB0 | ((len(body) + 9) >> 8), (len(body) + 9) & 0xFF, key >> 8, key & 0xFF, 0xC1, 0, 0]) + body
    return head + crc32_mpeg(head).to_bytes(4, "big")


def _table_packet(pid: int, section: bytes) -> bytes:
    p = bytes([0x47, 0x40 | (pid >> 8), pid & 0xFF, 0x10, 0]) + section
    return p + b"\xff" * (PACKET - len(p))


_PAT = _table_packet(0, _section(0x00, 1, bytes([PROGRAM >> 8, PROGRAM & 0xFF, 0xE0 | (PMT_PID >> 8), PMT_PID & 0xFF])))
_PMT = _table_packet(
    PMT_PID, _section(0x02, PROGRAM, bytes([0xE0 | (ES_PID >> 8), ES_PID & 0xFF, 0xF0, 0, STREAM_TYPE, 0xE0 | (ES_PID >> 8), ES_PID & 0xFF, 0xF0, 0]))
)


def _stamp(pts: np.ndarray) -> np.ndarray:
    """The five bytes of each 33-bit time stamp with its marker bits."""
    return np.stack([0x21 | ((pts >> 29) & 0x0E), (pts >> 22) & 0xFF, 0x01 | ((pts >> 14) & 0xFE), (pts >> 7) & 0xFF, 0x01 | ((pts << 1) & 0xFE)], axis=1).astype(np.uint8)


def mux(payload: bytes) -> bytes:
    """The transport stream that carries `payload`: the packets of each access unit, and two table packets before every GOP."""
    n = len(payload)
    if not n:
        return _PAT + _PMT
    units = -(-n // UNIT_BYTES)
    sizes = np.full(units, UNIT_BYTES, np.int64)
    sizes[-1] = n - UNIT_BYTES * (units - 1)
    first_room = BODY - 8 - 14  # after the adaptation field of flags and PCR, and the PES header with PTS
    count = 1 + np.maximum(0, -(-(sizes - first_room) // BODY))
    total = int(count.sum())
    out = np.full((total, PACKET), 0xFF, np.uint8)
    start = np.cumsum(count) - count
    is_start = np.zeros(total, bool)
    is_start[start] = True
    unit_of = np.repeat(np.arange(units), count)
    k = np.arange(total) - start[unit_of]
    begin = np.where(k == 0, 0, first_room + (k - 1) * BODY)
    length = np.minimum(sizes[unit_of] - begin, np.where(k == 0, first_room, BODY))
    room = np.where(k == 0, first_room, BODY)
    stuffing = room - length
    out[:, 0] = 0x47
    out[:, 1] = (ES_PID >> 8) | (is_start << 6)
    out[:, 2] = ES_PID & 0xFF
    out[:, 3] = np.where(is_start | (stuffing > 0), 0x30, 0x10) | (np.arange(total) & 0x0F)
    # Adaptation fields: unit starts carry flags and the clock; stuffing fills up the last packet of a unit.
    ticks = np.arange(units, dtype=np.int64) * UNIT_TICKS & ((1 << 33) - 1)
    out[start, 4] = 7 + stuffing[start]
    out[start, 5] = 0x10 | ((np.arange(units) % GOP == 0) << 6)
    for i, shift in enumerate((25, 17, 9, 1)):
        out[start, 6 + i] = (ticks >> shift) & 0xFF
    out[start, 10] = ((ticks & 1) << 7) | 0x7E
    out[start, 11] = 0
    later = np.flatnonzero(~is_start & (stuffing > 0))
    out[later, 4] = stuffing[later] - 1
    two = later[stuffing[later] > 1]
    out[two, 5] = 0
    # The PES header stands right before the unit's first bytes, at the end of the packet.
    pes = np.empty((units, 14), np.uint8)
    pes[:, :4] = (0, 0, 1, STREAM_ID)
    pes[:, 4], pes[:, 5] = (sizes + 8) >> 8, (sizes + 8) & 0xFF
    pes[:, 6], pes[:, 7], pes[:, 8] = 0x84, 0x80, 5
    pes[:, 9:] = _stamp(ticks)
    at = PACKET - length[start] - 14
    flat = out.reshape(-1)
    flat[(start * PACKET + at)[:, None] + np.arange(14)] = pes
    # The payload's bytes fill each packet's end, in order.
    ends = np.arange(1, total + 1) * PACKET
    flat[ranges(ends - length, length)] = np.frombuffer(payload, np.uint8)
    group = np.arange(units) // GOP
    whole = np.empty((total + 2 * (int(group[-1]) + 1), PACKET), np.uint8)
    whole[np.arange(total) + 2 * (group[unit_of] + 1)] = out
    first = start[::GOP] + 2 * np.arange(int(group[-1]) + 1)
    for place, table in ((first, _PAT), (first + 1, _PMT)):
        whole[place] = np.frombuffer(table, np.uint8)
        whole[place, 3] |= (np.arange(len(place)) & 0x0F).astype(np.uint8)
    return whole.tobytes()


def _pids(packets: np.ndarray) -> np.ndarray:
    return ((packets[:, 1].astype(np.int64) & 0x1F) << 8) | packets[:, 2]


def _payload_at(packets: np.ndarray) -> np.ndarray:
    """Where each packet's payload begins; PACKET where it has none."""
    control = (packets[:, 3] >> 4) & 3
    skip = 4 + np.where(control >= 2, packets[:, 4].astype(np.int64) + 1, 0)
    if (skip[control & 1 == 1] > PACKET).any():
        raise StreamError("an adaptation field is too long")
    return np.where(control & 1, skip, PACKET)


def _flags(packets: np.ndarray) -> np.ndarray:
    """The flag byte of each adaptation field; 0 without one."""
    return np.where((packets[:, 3] & 0x20 != 0) & (packets[:, 4] > 0), packets[:, 5], 0)


def _in_order(packets: np.ndarray) -> np.ndarray:
    """One stream's packets that have a payload, without those sent twice. Raises where a counter jumps unannounced."""
    at = _payload_at(packets)
    full = np.flatnonzero(at < PACKET)
    own, at = packets[full], at[full]
    step = np.diff(own[:, 3].astype(np.int64) & 0x0F) & 0x0F
    announced = np.cumsum(_flags(packets) & 0x80 != 0)[full]
    odd = np.flatnonzero((step != 1) & (announced[1:] == announced[:-1])) + 1
    twice: set[int] = set()
    for k in odd.tolist():
        if step[k - 1] or k - 1 in twice or at[k] != at[k - 1] or own[k, at[k] :].tobytes() != own[k - 1, at[k] :].tobytes():
            raise StreamError("a continuity counter jumps")
        twice.add(k)
    return np.delete(own, sorted(twice), axis=0)


def sections(packets: np.ndarray) -> list[bytes]:
    """The whole table sections that one stream's packets carry, CRCs checked and cut off."""
    own = _in_order(packets)
    out: list[bytes] = []
    open_section = b""
    begun = False

    def closed(raw: bytes) -> bytes:
        """Take whole sections from the front; the rest is open."""
        while len(raw) >= 3 and raw[0] != 0xFF:
            size = 3 + (((raw[1] & 0x0F) << 8) | raw[2])
            if len(raw) < size:
                return raw
            if crc32_mpeg(raw[:size]):
                raise StreamError(f"table {raw[0]} is damaged")
            out.append(raw[: size - 4])
            raw = raw[size:]
        return b"" if raw[:1] == b"\xff" else raw

    for packet, at in zip(own, _payload_at(own).tolist(), strict=True):
        raw = packet[at:].tobytes()
        if packet[1] & 0x40:
            if begun and open_section:
                closed(open_section + raw[1 : 1 + raw[0]])
            open_section, begun = closed(raw[1 + raw[0] :]), True
        elif begun and open_section:
            open_section = closed(open_section + raw)
    return out


def _newest(packets: np.ndarray, table_id: int) -> bytes:
    """The body of the last section of a table that is in force."""
    found = [x for x in sections(packets) if x[0] == table_id and len(x) >= 8 and x[5] & 1]
    if not found:
        raise StreamError(f"no packet of table {table_id}")
    return found[-1][8:]


def programs(pat: bytes) -> dict[int, int]:
    """Program number to the PID of its map; the network's entry (number 0) isn't a program."""
    pairs = [(pat[k] << 8 | pat[k + 1], (pat[k + 2] & 0x1F) << 8 | pat[k + 3]) for k in range(0, len(pat) - 3, 4)]
    return {number: pid for number, pid in pairs if number}


def streams(pmt: bytes) -> list[tuple[int, int]]:
    """Stream type and PID of each stream of a program, past all descriptors."""
    k, out = 4 + ((pmt[2] & 0x0F) << 8 | pmt[3]), []
    while k + 5 <= len(pmt):
        out.append((pmt[k], (pmt[k + 1] & 0x1F) << 8 | pmt[k + 2]))
        k += 5 + ((pmt[k + 3] & 0x0F) << 8 | pmt[k + 4])
    return out


def demux(stream: bytes, program: int | None = None, stream_type: int | None = None) -> dict:
    """payload; pts (-1 without one), random_access and size of each PES packet; number of packets; streams of the program.

    Of the given program (else the first) the first stream of the given type (else the first of all). Raises StreamError.
    """
    if len(stream) % PACKET or not stream:
        raise StreamError("not a whole number of packets")
    packets = np.frombuffer(stream, np.uint8).reshape(-1, PACKET)
    if (packets[:, 0] != 0x47).any():
        raise StreamError("lost sync")
    pid = _pids(packets)
    if (packets[pid != NULL_PID, 1] & 0x80).any():
        raise StreamError("a packet is marked as damaged")
    maps = programs(_newest(packets[pid == 0], 0x00))
    if not maps or program is not None and program not in maps:
        raise StreamError("no such program")
    listed = streams(_newest(packets[pid == maps[program if program is not None else min(maps)]], 0x02))
    chosen = [p for kind, p in listed if stream_type is None or kind == stream_type]
    if not chosen:
        raise StreamError("no such stream")
    found = {"streams": listed, "packets": len(packets)}
    own = _in_order(packets[pid == chosen[0]])
    total = len(own)
    if not total:
        return found | {"payload": b"", "pts": np.empty(0, np.int64), "random_access": np.empty(0, bool), "sizes": np.empty(0, np.int64)}
    if (own[:, 3] & 0xC0).any():
        raise StreamError("the stream is scrambled")
    skip = _payload_at(own)
    starts = np.flatnonzero(own[:, 1] & 0x40)
    if not len(starts) or starts[0]:
        raise StreamError("the stream doesn't begin with an access unit")
    if (skip[starts] > PACKET - 6).any():
        raise StreamError("an elementary packet has no header")
    # Headers are read 14 bytes wide, up to the packet's end.
    head = own.reshape(-1)[starts[:, None] * PACKET + np.minimum(skip[starts][:, None] + np.arange(14), PACKET - 1)].astype(np.int64)
    if (head[:, :3] != (0, 0, 1)).any():
        raise StreamError("an elementary packet has no start code")
    bare = np.isin(head[:, 3], BARE_IDS)
    stamped = ~bare & (head[:, 7] & 0x80 != 0)
    front = np.where(bare, 6, 9 + head[:, 8])
    if (skip[starts] + front > PACKET).any() or (head[stamped, 8] < 5).any():
        raise StreamError("an elementary packet's header is cut off")
    declared = head[:, 4] << 8 | head[:, 5]
    skip[starts] += front
    length = PACKET - skip
    sizes = np.add.reduceat(length, starts)
    if ((declared > 0) & (declared + 6 - front != sizes)).any():
        raise StreamError("an elementary packet is incomplete")
    pts = np.where(stamped, ((head[:, 9] >> 1) & 7) << 30 | head[:, 10] << 22 | (head[:, 11] >> 1) << 15 | head[:, 12] << 7 | head[:, 13] >> 1, -1)
    payload = own.reshape(-1)[ranges(np.arange(total) * PACKET + skip, length)].tobytes()
    return found | {"payload": payload, "pts": pts, "random_access": _flags(own)[starts] & 0x40 != 0, "sizes": sizes}


def padded(text: bytes) -> bytes:
    """Zero bytes up to a positive multiple of 64."""
    return text + b"\0" * (-len(text) % PAD or (0 if text else PAD))


def _mux_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = buffers(batch.column(1))
        for i, j in slices(off):
            texts = [data[a:b].tobytes() for a, b in zip(off[i:j].tolist(), off[i + 1 : j + 1].tolist(), strict=True)]
            media = pa.array([mux(padded(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array([len(t) for t in texts], pa.int64()), media], ["doc_id", "n_bytes", "media"])


def media_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media: the stored stream of each document's padded UTF-8 text."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(source.mapInArrow(_mux_batches, "doc_id long, n_bytes long, media binary"), "mpegts")


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, packets long, units long, first_pts long, last_pts long, random_access array<long>"


def _demux_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in FEATURES.split(", ")]
    for batch in batches:
        rows = []
        for doc_id, n, media in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            x = demux(media)
            p, pts = x["payload"], x["pts"]
            points = pts[x["random_access"]]
            mean = int(np.frombuffer(p, np.uint8).mean() * 1000) if p else 0
            feature = f"packets={x['packets']};units={len(pts)};points={len(points)};ticks={int(pts[-1]) if len(pts) else 0};mean={mean}"
            rows.append((
                doc_id, n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-PAD:]), len(media), hashlib.sha256(media).hexdigest(), feature,
                x["packets"], len(pts), int(pts[0]) if len(pts) else None, int(pts[-1]) if len(pts) else None, points.tolist(),
            ))
        kinds = [pa.int64() if " long" in f else pa.list_(pa.int64()) if "array" in f else pa.string() for f in FEATURES.replace("array<long>", "array").split(", ")]
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def features(media: DataFrame) -> DataFrame:
    """Parse each stored stream and return what it holds: lengths, digests, timestamps and random-access points."""
    return media.mapInArrow(_demux_batches, FEATURES)
