"""Widely published sentences with their published contents: a truth for the decoder that this library's encoder has no part in."""

from seatracks.operators import decode as D

#: layout, channel, payloads and pad of each part, and published values (names in capitals as sent, numbers as coded).
KNOWN = {
    "moored": ("cnb", "B", ["177KQJ5000G?tO`K>RA1wUbN0TKH"], 0, {"msgtype": 1, "mmsi": "477553000", "status": 5, "speed": 0, "lon": -73407500, "lat": 28549700, "course": 510, "heading": 181, "second": 15}),
    "under way": ("cnb", "A", ["15RTgt0PAso;90TKcjM8h6g208CQ"], 0, {"msgtype": 1, "mmsi": "371798000", "status": 0, "turn": -127, "speed": 123, "accuracy": 1, "lon": -74037230, "lat": 29028976, "course": 2240, "heading": 215, "second": 33}),
    "no heading": ("cnb", "A", ["13HOI:0P0000VOHLCnHQKwvL05Ip"], 0, {"msgtype": 1, "mmsi": "227006760", "status": 0, "turn": -128, "speed": 0, "lon": 78828, "lat": 29685348, "course": 367, "heading": 511, "second": 14}),
    "base station": ("type4", "A", ["403OviQuMGCqWrRO9>E6fE700@GO"], 0, {"msgtype": 4, "mmsi": "003669702", "year": 2007, "month": 5, "day": 14, "hour": 19, "minute": 57, "second": 39, "lon": -45811416, "lat": 22130262}),
    "voyage": (
        "type5", "A", ["55?MbV02;H;s<HtKR20EHE:0@T4@Dn2222222216L961O5Gf0NSQEp6ClRp8", "88888888880"], 2,
        {"msgtype": 5, "mmsi": "351759000", "imo_id": 9134270, "callsign": "3FOF8", "shipname": "EVER DIADEM", "shiptype": 70, "month": 5, "day": 15, "hour": 14, "minute": 0, "draught": 122, "destination": "NEW YORK"},
    ),
    "aircraft": ("type9", "B", ["91b55wi;hbOS@OdQAC062Ch2089h"], 0, {"msgtype": 9, "mmsi": "111232511", "alt": 303, "speed": 42, "lon": -3767306, "lat": 34886402, "course": 1545, "second": 15}),
    "class B": ("type18", "A", ["B52K>;h00Fc>jpUlNV@ikwpUoP06"], 0, {"msgtype": 18, "mmsi": "338087471", "speed": 1, "lon": -44443279, "lat": 24410724, "course": 796, "heading": 511, "second": 49}),
    "class B name": ("type24a", "A", ["H42O55i18tMET00000000000000"], 2, {"msgtype": 24, "mmsi": "271041815", "shipname": "PROGUY"}),
    "class B ship": ("type24b1", "A", ["H42O55lti4hhhilD3nink000?050"], 0, {"msgtype": 24, "mmsi": "271041815", "shiptype": 60, "callsign": "TC6163", "to_bow": 0, "to_stern": 15, "to_port": 0, "to_starbord": 5}),
}


def sentence(channel, payload, pad, part, parts):
    body = f"AIVDM,{parts},{part},{'' if parts == 1 else 1},{channel},{payload},{pad}"
    check = 0
    for c in body:
        check ^= ord(c)
    return f"!{body}*{check:02X}"


def test_published_contents(spark):
    lines = []
    for k, (_, channel, payloads, pad, _) in enumerate(KNOWN.values()):
        lines += [(str(k), i, "20200101T000000.000Z", sentence(channel, p, pad if i == len(payloads) else 0, i, len(payloads))) for i, p in enumerate(payloads, 1)]
    df = spark.createDataFrame(lines, "path string, line_no int, date string, sentence string")
    ok, bad = D.verify_sentences(df)
    assert not bad.count()
    tables = D.decode(D.assemble(ok))
    for k, (name, (layout, _, _, _, want)) in enumerate(KNOWN.items()):
        (row,) = tables[layout].where(f"path = '{k}'").collect()
        got = {f: row[f].strip() if isinstance(row[f], str) else row[f] for f in want}
        same = {f: int(got[f]) == int(v) if f == "mmsi" else abs(got[f] - v) <= 9 if f in ("lon", "lat") else got[f] == v for f, v in want.items()}  # degrees are published with five digits
        assert all(same.values()), (name, got, want)
