"""Media columns as MPEG transport streams.

``mux`` writes bytes as a single-program stream: a program association and a program map table, then access units as
packetised elementary stream (PES) packets with a presentation timestamp; every ``RAP_EVERY``-th unit is marked as a
random-access point and each unit starts with a clock reference. ``demux`` trusts none of this: it finds the stream
through the tables (checking their CRC), checks every continuity counter, reassembles the PES packets and notes
timestamps and random-access points. A table holds one stream per row, so rows are independent and nothing is
shuffled; the largest row bounds a task's memory.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import zlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitymart.llm.common import per_batch, stored

PACKET, SYNC = 188, 0x47
PROGRAM_PID, STREAM_PID = 0x1000, 0x0100
#: Bytes of an access unit, ticks between two (90 kHz at 25 a second), and units from one random-access point to the next.
UNIT, TICKS, RAP_EVERY = 16 * 576, 3600, 4
#: Payloads are filled with this byte to a positive multiple of BLOCK.
FILL, BLOCK = b"\xff", 576


@functools.lru_cache(256)
def crc_mpeg(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = ((crc << 1) ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def section(table_id: int, ident: int, body: bytes) -> bytes:
    head = bytes([table_id]) + (0xB000 | len(body) + 9).to_bytes(2, "big") + ident.to_bytes(2, "big") + b"\xc1\0\0"
    return head + body + crc_mpeg(head + body).to_bytes(4, "big")


def section_packets(pid: int, data: bytes) -> list[bytes]:
    """A section in as many packets as it takes."""
    data, out = b"\0" + data, []
    for n, at in enumerate(range(0, len(data), PACKET - 4)):
        head = bytes([SYNC]) + ((0x4000 if n == 0 else 0) | pid).to_bytes(2, "big") + bytes([0x10 | n & 15])
        out.append((head + data[at : at + PACKET - 4]).ljust(PACKET, b"\xff"))
    return out


@functools.lru_cache(64)
def table_packets(pids: tuple[int, ...] = (STREAM_PID,)) -> bytes:
    pat = section(0, 1, (1).to_bytes(2, "big") + (0xE000 | PROGRAM_PID).to_bytes(2, "big"))
    streams = b"".join(b"\x06" + (0xE000 | pid).to_bytes(2, "big") + b"\xf0\0" for pid in pids)
    pmt = section(2, 1, (0xE000 | pids[0]).to_bytes(2, "big") + b"\xf0\0" + streams)
    return b"".join(section_packets(0, pat) + section_packets(PROGRAM_PID, pmt))


def stamp(ticks: int) -> bytes:
    """A 33-bit presentation timestamp in its five bytes with marker bits."""
    t = ticks & (1 << 33) - 1
    return bytes([0x21 | t >> 29 & 0x0E, t >> 22 & 0xFF, 0x01 | t >> 14 & 0xFE, t >> 7 & 0xFF, 0x01 | t << 1 & 0xFE])


def unstamp(b: bytes) -> int:
    return (b[0] >> 1 & 7) << 30 | b[1] << 22 | b[2] >> 1 << 15 | b[3] << 7 | b[4] >> 1


def stream_packets(payload: bytes, pid: int = STREAM_PID) -> list[bytes]:
    """The packets of one elementary stream."""
    out, counter = [], 0
    first = bytes([SYNC, pid >> 8 | 0x40, pid & 0xFF])
    later = bytes([SYNC, pid >> 8, pid & 0xFF])
    plain = [later + bytes([0x10 | c]) for c in range(16)]
    for unit, at in enumerate(range(0, len(payload), UNIT)):
        ticks = unit * TICKS
        data = payload[at : at + UNIT]
        pes = b"\0\0\1\xbd" + (len(data) + 8).to_bytes(2, "big") + b"\x80\x80\x05" + stamp(ticks) + data
        flags = 0x10 | (0x40 if unit % RAP_EVERY == 0 else 0)
        clock = ((ticks & (1 << 33) - 1) << 15 | 0x7E00).to_bytes(6, "big")
        field, head, done = bytes([flags]) + clock, first, 0
        while done < len(pes):
            room = PACKET - 5 - len(field) if field else PACKET - 4
            left = len(pes) - done
            if left < room:  # the last packet is stuffed through its adaptation field
                if not field and left == room - 1:
                    out.append(head + bytes([0x30 | counter, 0]) + pes[done:])
                else:
                    field = field or b"\0"
                    size = PACKET - 5 - left
                    out.append(head + bytes([0x30 | counter, size]) + field.ljust(size, b"\xff") + pes[done:])
                done = len(pes)
            elif field:
                out.append(head + bytes([0x30 | counter, len(field)]) + field + pes[done : done + room])
                done += room
            else:
                out.append(plain[counter] + pes[done : done + room])
                done += room
            counter, field, head = counter + 1 & 15, b"", later
    return out


def mux(payload: bytes) -> bytes:
    return table_packets() + b"".join(stream_packets(payload))


def mux_streams(payloads: dict[int, bytes]) -> bytes:
    """Several elementary streams of one program, by PID, their packets in turns."""
    turns = itertools.zip_longest(*(stream_packets(data, pid) for pid, data in payloads.items()))
    return table_packets(tuple(payloads)) + b"".join(p for turn in turns for p in turn if p)


@dataclass
class Elementary:
    """What one PID carried: its access units, their timestamps, and the byte offsets of random-access points."""

    units: list[bytes] = field(default_factory=list)
    pts: list[int] = field(default_factory=list)
    rap: list[int] = field(default_factory=list)
    bad: int = 0
    pieces: list[bytes] = field(default_factory=list)

    @property
    def payload(self) -> bytes:
        return b"".join(self.units)

    def close(self) -> None:
        """Ends the PES packet that the pieces make up."""
        if not self.pieces:
            return
        pes = b"".join(self.pieces)
        self.pieces.clear()
        size = int.from_bytes(pes[4:6], "big")
        if len(pes) < 9 or pes[:3] != b"\0\0\1" or size not in (0, len(pes) - 6) or 9 + pes[8] > len(pes):
            self.bad += 1
            return
        if pes[7] & 0x80 and pes[8] >= 5:
            self.pts.append(unstamp(pes[9:14]))
        self.units.append(pes[9 + pes[8] :])


class Tables:
    """Sections of the program tables, gathered over packets: programs by the PID of their map, elementary streams in order of mention."""

    def __init__(self) -> None:
        self.programs: dict[int, int] = {}
        self.streams: dict[int, Elementary] = {}
        self.open: dict[int, bytes] = {}
        self.bad = 0

    def add(self, pid: int, start: bool, data: bytes) -> None:
        if start:
            pointer = 1 + data[0] if data else 1
            if pid in self.open:
                self.take(pid, self.open[pid] + data[1:pointer])
            self.take(pid, data[pointer:])
        elif pid in self.open:
            self.take(pid, self.open[pid] + data)

    def take(self, pid: int, data: bytes) -> None:
        """Reads the whole sections of ``data`` and keeps the rest."""
        self.open.pop(pid, None)
        while data and data[0] != 0xFF:  # 0xFF: stuffing to the packet's end
            size = 3 + ((data[1] & 0x0F) << 8 | data[2]) if len(data) > 2 else len(data) + 1
            if size > len(data):
                self.open[pid] = data
                return
            self.read(pid, data[:size])
            data = data[size:]

    def read(self, pid: int, data: bytes) -> None:
        if len(data) < 12 or crc_mpeg(data[:-4]) != int.from_bytes(data[-4:], "big"):
            self.bad += 1
        elif pid == 0 and data[0] == 0:
            for i in range(8, len(data) - 7, 4):
                if number := data[i] << 8 | data[i + 1]:  # program 0 names the network table
                    self.programs[(data[i + 2] & 0x1F) << 8 | data[i + 3]] = number
        elif pid in self.programs and data[0] == 2:
            i = 12 + ((data[10] & 0x0F) << 8 | data[11])
            while i + 9 <= len(data):
                self.streams.setdefault((data[i + 1] & 0x1F) << 8 | data[i + 2], Elementary())
                i += 5 + ((data[i + 3] & 0x0F) << 8 | data[i + 4])


def next_sync(media: bytes, at: int) -> int:
    """The next sync byte that another one follows a packet later, or the end does."""
    while (at := media.find(SYNC, at)) >= 0:
        if at + PACKET >= len(media) or media[at + PACKET] == SYNC:
            return at
        at += 1
    return len(media)


def demux(media: bytes) -> dict:
    """The elementary streams, by PID, and what the packets say; ``payload``, ``pts`` and ``rap`` are those of the first stream in the tables.

    Damage is counted, never raised: bytes where a sync byte should be (``lost_sync``, once until it is found again), counters that do not
    follow (``cc_errors``; a packet may come twice, and one flagged as discontinuous may jump), tables with a wrong CRC and PES packets of
    another length than stated (``bad``)."""
    tables, last = Tables(), {}
    packets = lost = errors = at = 0
    while at < len(media):
        packets += 1
        if media[at] != SYNC or at + PACKET > len(media):
            lost += 1
            at = next_sync(media, at + 1) if at + PACKET <= len(media) else len(media)
            continue
        packet, place = media[at : at + PACKET], at
        at += PACKET
        pid, start, control = (packet[1] & 0x1F) << 8 | packet[2], 4, packet[3] >> 4 & 3
        stream, jumps = tables.streams.get(pid), False
        if control & 2:
            size = packet[4]
            start = 5 + size
            jumps = size > 0 and bool(packet[5] & 0x80)
            if size and packet[5] & 0x40 and stream:
                stream.rap.append(place)
        if not control & 1 or start > PACKET or packet[1] & 0x80:
            continue
        counter, data = packet[3] & 15, packet[start:]
        before = last.get(pid)
        if before and before[0] == counter and before[1] == data:
            last[pid] = counter, None  # only once
            continue
        if before and not jumps and counter != before[0] + 1 & 15:
            errors += 1
            tables.open.pop(pid, None)
        last[pid] = counter, data
        if stream:
            if packet[1] & 0x40:
                stream.close()
            if packet[1] & 0x40 or stream.pieces:
                stream.pieces.append(data)
        elif pid == 0 or pid in tables.programs:
            tables.add(pid, bool(packet[1] & 0x40), data)
    for stream in tables.streams.values():
        stream.close()
    first = next(iter(tables.streams.values()), Elementary())
    return {
        "packets": packets, "lost_sync": lost, "cc_errors": errors, "bad": tables.bad + sum(s.bad for s in tables.streams.values()),
        "programs": len(tables.programs), "elementary": tables.streams, "streams": len(tables.streams),
        "payload": first.payload, "units": len(first.units), "pts": first.pts, "rap": first.rap,
    }


def write_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stream a row: (id, n_bytes, media). A null text counts as empty; every payload has a block at least."""

    def make(batch):
        texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
        fill = [-len(t) % BLOCK if t else BLOCK for t in texts]
        return {id_col: batch.column(0), "n_bytes": list(map(len, texts)), "media": [mux(t + FILL * n) for t, n in zip(texts, fill)]}

    return per_batch(docs.select(F.col(id_col).cast("long"), text_col), make, f"{id_col} long, n_bytes long, media binary")


SCHEMA = (
    "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, "
    "pts array<long>, rap_offsets array<long>"
)


def read_media(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Features of every stored stream, with the timestamps and the byte offsets of the random-access points of its first elementary stream."""

    def make(batch):
        rows = []
        for m in batch.column(2).to_pylist():
            x = demux(m)
            p, pts = x["payload"], x["pts"]
            said = (
                f"programs={x['programs']} streams={x['streams']} packets={x['packets']} lost_sync={x['lost_sync']} cc_errors={x['cc_errors']} "
                f"bad={x['bad']} units={x['units']} raps={len(x['rap'])} pts={pts[0] if pts else -1}..{pts[-1] if pts else -1}"
            )
            rows.append((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(m), hashlib.sha256(m).hexdigest(), said, pts, x["rap"]))
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return {id_col: batch.column(0), "n_bytes": batch.column(1)} | dict(zip(names, map(list, zip(*rows))))

    return per_batch(media.select(id_col, "n_bytes", "media"), make, f"{id_col} long, n_bytes long, {SCHEMA}")


def media_features(docs: DataFrame) -> DataFrame:
    """Stores every text of ``docs`` as a transport stream in a Parquet table, reads the table back and describes each
    row. Nulls count as empty texts, repeated rows give repeated results, extra columns are not read, an empty table
    gives an empty result, a null id stays null."""
    return read_media(stored(write_media(docs), "media-ts"))
