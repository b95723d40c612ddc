"""Small export files in the supervision tool's format (BOM, sep= line, CRLF, ';')."""

from __future__ import annotations

import os

from trackyard.schemas import SOURCES


def write_export(folder: str, name: str, header: list[str], rows: list[list[str]], sep_line: bool = True,
                 bom: bool = True, sep: str = ";") -> str:
    os.makedirs(folder, exist_ok=True)
    lines = []
    if sep_line:
        lines.append(f'"sep={sep}"')
    lines.append(sep.join(header))
    lines += [sep.join(r) for r in rows]
    text = "\r\n".join(lines) + "\r\n"
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write((b"\xef\xbb\xbf" if bom else b"") + text.encode("utf-8"))
    return path


def headers(table: str, title_case: bool = True) -> list[str]:
    hs = [c.header for c in SOURCES[table].columns]
    return [h.title() if title_case else h for h in hs]


def transactions_rows() -> list[list[str]]:
    # start; stop; setup; estab; duration; lacs/cis; nid; nid_op; tmsi; realloc; imsi; msisdn; imei; calling;
    # called; route; fn; fn_ct; direction; type; subtype; app; gsmr; prio; root; layer; event; cause; algo
    base = ["", "", "3s 591ms", "1s 200ms", "1min 2s 3ms", "1", "2", "3", "4", "13048", "", "A1B2", "",
            "604070051706194", "212799997194", "35214500047160", "00212799997194", "799990099", "x",
            "20108101", "", "MO", "Call", "Sub", "App", "Connected", "Level 2", "Success", "L3", "End", "", "A5/1"]
    rows = []
    for i, (start, stop, imsi) in enumerate([
            ("2026-05-13 10:00:00.000", "2026-05-13 10:01:00.000", "604070051706194"),
            ("2026-05-13 10:05:00.000", "Call running...", "604070051706194"),
            ("2026-05-13 10:06:00.000", "2026-05-13 10:07:00.000", ""),
            ("2026-05-13 10:06:00.000", "2026-05-13 10:08:00.000", ""),  # same NULL-imsi key: collapses
            ("2026-05-13 10:09:00.000", "2026-05-13 10:09:30.000", "604070051701036")]):
        r = list(base)
        r[0], r[1], r[13] = start, stop, imsi
        r[11] = f"T{i}"
        rows.append(r)
    return rows


def handover_rows() -> list[list[str]]:
    return [
        ["2026-05-13 10:00:00.000", "2026-05-13 10:01:00.000", "2026-05-13 10:00:30.000", "1.234", "100", "5",
         "101", "6", "604070051706194", "212799997194", "35214500047160", "10", "Voice", "Intra", "OK", "Normal",
         "Better cell"],
        ["2026-05-13 10:00:00.000", "2026-05-13 10:01:00.000", "2026-05-13 10:00:30.000", "2.5", "100", "5",
         "102", "7", "604070051706194", "212799997194", "35214500047160", "10", "Voice", "Intra", "OK", "Normal",
         "Better cell"],  # same key (imsi, ho_start, src): the later row wins
        ["2026-05-13 11:00:00.000", "", "2026-05-13 11:00:10.000", "0.040", "200", "9", "201", "8",
         "604070051799999", "", "", "", "Data", "Inter", "Fail", "Timeout", "Load"],
    ]


def frame_error_rows() -> list[list[str]]:
    return [
        ["2026-05-13 10:00:00.000", "2026-05-13 10:01:00.000", "2026-05-13 10:00:05.000", "E1 probe", "13048",
         "1037", "212799997194", "799990099", "810", "6001", "2", "Full", "Uplink", "CRC", "3"],
        ["2026-05-13 10:00:00.000", "2026-05-13 10:01:00.000", "2026-05-13 10:00:06.000", "E1 probe", "13048",
         "1037", "00212799999999", "799990099", "810", "6001", "2", "Full", "Downlink", "CRC", "1"],
    ]


INCIDENT_HEADER = [c.header for c in SOURCES["sp_ertms_disconnects"].columns]


def incident_rows() -> list[list[str]]:
    def row(order, date, heure, imei, mrm, km):
        r = [""] * len(INCIDENT_HEADER)
        r[0], r[1], r[2], r[3], r[8], r[7], r[10] = order, "True", date, heure, imei, mrm, km
        r[4], r[5], r[9], r[12], r[13] = "4411", "12", "Pair", "2", "Deconnexion"
        r[33] = "2026-06-01"
        return r
    rows = [row("1", "2026-05-13", "10:15:00", "35214500047160", "12", "12,5"),
            row("2", "2026-05-13", "10:15:00", "35214500047160", " 7 ", "PK 3"),  # same key: later row wins
            row("3", "2026-05-14", "08:00:00", "", "x1", "101.25"),
            row("4", "14/05/2026", "09:30", "35214500099999", "", "")]   # French-locale date, short time
    rows[2][1], rows[3][1] = "FAUX", "VRAI"
    return rows


# --- invented sample exports of three sources, with what must come of them ------------------------

IMSI = 604070051706194


def _rows(table: str, cells: list[dict]) -> list[list[str]]:
    return [[str(c.get(col.name, "")) for col in SOURCES[table].columns] for c in cells]


def etcs_cells() -> list[dict]:
    out = []
    for i in range(57):
        start = f"2026-05-13 {8 + i // 20:02d}:{i % 20 + 10}:{i:02d}"
        out.append({
            "start_time": start + ".000", "stop_time": "Call running..." if i in (5, 40) else start + ".500",
            "call_setup_duration": f"{3 - i % 3}s {591 - i}ms", "transaction_duration": f"{i % 60}min {i % 50}s {i}ms",
            "etcs_baseline": 2, "system_version": "1.0", "nid_engine": 13000 + i % 40, "imsi": IMSI + i % 40,
            "msisdn": 212799997194 + i % 40, "imei": 35214500047160 + i % 40, "calling_number": "00212799997194",
            "root_failure": "Success"})
    return out


def matrix_cells() -> list[dict]:
    return [{"imsi": IMSI + 10 + i, "msisdn": 212799997204 + i, "last_imsi_time": f"2026-05-12 07:{i:02d}:00.000"}
            for i in range(35)]


def group_call_cells() -> list[dict]:
    out = []
    for i in range(27):
        out.append({
            "start_time": f"2026-05-13 12:{i:02d}:00.000", "stop_time": f"2026-05-13 12:{i:02d}:30.000", "gid": 200 + i % 3,
            "functional_number": 7000 + i, "imsi": "" if i < 10 else IMSI + 100 + i,
            "establishment_delay": "" if i % 4 == 0 else f"{i % 3}s {i}ms", "vgcs_duration": f"{i}s",
            "sccp_success_rate": "" if i % 5 == 0 else f"{i % 3} / 3", "cell_success_rate": f"{i % 2} / 2",
            "dispatcher_success_rate": "0 / 0" if i < 3 else "1 / 2"})
    return out


SAMPLE_FILES = {"ETCS-Call-tracing_2026-05-13_16-44-29.csv": ("exp_etcs_call", etcs_cells),
                "Subscriber-Matrix_2026-05-13_16-44-41.csv": ("exp_subscriber_matrix", matrix_cells),
                "VGCS-_-VBS-_-REC-tracing_2026-05-13_16-45-02.csv": ("exp_vgcs_vbs_rec_tracing", group_call_cells)}


def write_samples(folder: str) -> str:
    for name, (table, cells) in SAMPLE_FILES.items():
        write_export(folder, name, headers(table), _rows(table, cells()))
    return folder


def duration_sum(cells: list[dict], name: str) -> int:
    """Milliseconds of texts like '1min 2s 3ms', worked out in plain Python."""
    scale = {"min": 60_000, "ms": 1, "s": 1000}
    total = 0
    for c in cells:
        for part in str(c.get(name, "")).split():
            unit = next(u for u in scale if part.endswith(u))
            total += int(part.removesuffix(unit)) * scale[unit]
    return total


SUBSCRIBERS = len({c["imsi"] for cells in (etcs_cells(), matrix_cells(), group_call_cells()) for c in cells if c["imsi"]})
