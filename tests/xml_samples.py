"""Small market documents, built from values."""

ZONE = "10YTEST-NORTH--7"


def tag(name, *content):
    return f"<{name}>{''.join(str(c) for c in content)}</{name}>"


def period(start, end, resolution, points, amount="quantity", interval="timeInterval"):
    body = "".join(tag("Point", tag("position", p), tag(amount, v)) for p, v in points)
    return tag(
        "Period", tag(interval, tag("start", start), tag("end", end)),
        tag("resolution", resolution), body,
    )


def series(name, parts, *periods):
    return tag("TimeSeries", tag("mRID", name), *[tag(k, v) for k, v in parts], *periods)


def document(root, kind, name, series_list, process=True, created="2025-03-12T14:05:09Z"):
    head = [tag("mRID", name), tag("revisionNumber", 1), tag("type", kind)]
    head += [tag("process.processType", "A16")] if process else []
    return (
        f'<?xml version="1.0" encoding="UTF-8"?>\n<{root} xmlns="urn:test:document">'
        + "".join(head) + tag("createdDateTime", created) + "".join(series_list)
        + f"</{root}>"
    )


LOAD_PARTS = (
    ("businessType", "A04"), ("objectAggregation", "A01"),
    ("outBiddingZone_Domain.mRID", ZONE), ("quantity_Measure_Unit.name", "MAW"),
    ("curveType", "A03"),
)
HOUR = ("2025-03-10T00:00Z", "2025-03-10T01:00Z")


def load():
    points = [(1, "412.75"), (3, "398.20")]
    return document(
        "GL_MarketDocument", "A65", "L-77",
        [series("ts-7a", LOAD_PARTS, period(*HOUR, "PT15M", points))],
    )


def generation():
    def one(name, zone_tag, points):
        parts = [p for p in LOAD_PARTS if not p[0].startswith("outBidding")]
        parts = [*parts, (zone_tag, ZONE), ("MktPSRType", tag("psrType", "B10"))]
        return series(name, parts, period(*HOUR, "PT15M", points))

    return document(
        "GL_MarketDocument", "A75", "G-41",
        [
            one("ts-fed", "outBiddingZone_Domain.mRID",
                [(1, "51.35"), (3, "48.9")]),
            one("ts-drawn", "inBiddingZone_Domain.mRID", [(1, "7.15")]),
        ],
    )


CLASSIFICATION = "classificationSequence_AttributeInstanceComponent.position"


def prices(classes=(2, 1), interval="timeInterval"):
    def one(number, position):
        parts = [
            ("auction.type", "A01"), ("businessType", "A62"), ("in_Domain.mRID", ZONE),
            ("out_Domain.mRID", ZONE), ("contract_MarketAgreement.type", "A01"),
            ("currency_Unit.name", "EUR"), ("price_Measure_Unit.name", "MWH"),
            ("curveType", "A03"),
        ]
        if position is not None:
            parts.append((CLASSIFICATION, position))
        return series(
            f"auction-{number}", parts,
            period("2025-03-09T22:00Z", "2025-03-10T22:00Z", "PT15M",
                   [(24, "88.41"), (26, "91.07")], "price.amount", interval),
        )

    return document(
        "Publication_MarketDocument", "A44", "P-5",
        [one(i + 1, c) for i, c in enumerate(classes)], process=False,
    )
