"""Compass directions: classification of counts, bearings, weights and decay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. They must equal the reference for right results; the order
# matters too, because the first key contained in a label wins. Keys with an
# umlaut never match, because labels are folded first; they are kept so that
# the table is whole.
# ---------------------------------------------------------------------------
INBOUND_WORDS = ("einwärts", "einwaerts")
OUTBOUND_WORDS = ("auswärts", "auswaerts")
CENTRE_LON, CENTRE_LAT = 8.5390, 47.3724
LABEL_BEARINGS = {
    "oerlikon": 45, "affoltern": 45, "schwamendingen": 45,
    "bucheggplatz": 0, "heimplatz": 15, "klusplatz": 20,
    "zoo": 30, "hoengg": 330, "hoenggerberg": 330, "zollikon": 80,
    "wipkingerplatz": 350, "limmatplatz": 0, "schaffhauserplatz": 10,
    "milchbuck": 20, "milchbucktunnel": 20, "universitaet": 30,
    "hegibachplatz": 40, "kreuzplatz": 40, "winterthur": 45,
    "zehntenhausplatz": 350,
    "vorderberg": 90,
    "see": 135, "bellevue": 135, "bellvue": 135,
    "sihlporte": 160, "central": 150, "stauffacher": 160,
    "hauptbahnhof": 140, "bahnhof": 140,
    "talstrasse": 150, "manessestrasse": 170,
    "birmensdorferstrasse": 190, "soodstrasse": 190,
    "sihlhoelzli": 180, "forchstrasse": 110, "hubertus": 180,
    "buerkliplatz": 150, "loewe": 150, "loewenplatz": 150,
    "rudolf": 150, "brun": 150, "rudolf-brun-bruecke": 150,
    "brudolf-brun-bruecke": 150, "enge": 170,
    "suedstrasse": 180, "selnau": 170,
    "nord": 0, "muehlegasse": 160,
    "chur": 180,
    "albisriederplatz": 270, "altstetten": 260, "altstetter": 260,
    "badenerstrasse": 260, "hardplatz": 260, "hardbruecke": 260,
    "hohlstrasse": 260, "pfingstweidstrasse": 280,
    "letzigrund": 260, "letzigraben": 260,
    "autobahn": 250, "bernerstrasse": 260,
    "helvetiaplatz": 250, "uetlibergtunnel": 210,
    "allmend": 200, "luggweg": 260,
    "altstetter-/luggwegstrasse": 260, "a3": 250,
    "schimmelstrasse": 260,
    "triemli": 210, "utogrund": 230, "albis": 220,
    "höngg": 330, "höngg/europabrücke": 330,
    "escher wyss": 350, "escher wyss platz": 350,
    "walcheplatz": 10, "mühlegasse": 160,
    "bleicherweg": 160,
}
COMFORT_BIKE = ((2.0, ("cycleway", "path")), (1.0, ("residential", "living_street")),
                (-0.5, ("primary", "secondary", "tertiary")))
COMFORT_PED = ((2.0, ("pedestrian", "living_street")), (1.0, ("footway", "path", "steps")),
               (-0.5, ("primary", "secondary", "tertiary")))
# ------------------------------------------------------------ end of fixed values


def _any_of(text: Column, words: tuple[str, ...]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | text.contains(word)
    return hit


def direction_kind(label: Column) -> Column:
    """``in``, ``out`` or ``label`` for a direction text; NULL counts as a label."""
    text = F.lower(F.trim(label))
    return (
        F.when(_any_of(text, INBOUND_WORDS), "in")
        .when(_any_of(text, OUTBOUND_WORDS), "out")
        .otherwise("label")
    )


def label_bearing(label: Column) -> Column:
    """Bearing of the first known place name contained in the folded label."""
    text = F.trim(F.lower(label))
    for umlaut, plain in (("ö", "oe"), ("ü", "ue"), ("ä", "ae")):
        text = F.replace(text, F.lit(umlaut), F.lit(plain))

    def first_hit(folded: Column) -> Column:
        return F.coalesce(*[
            F.when(folded.contains(place), F.lit(float(b))) for place, b in LABEL_BEARINGS.items()
        ])

    # the lambda binds the folded text, so that it is computed once for all names
    return F.element_at(F.transform(F.array(text), first_hit), 1)


def bearing_to_centre(lon: Column, lat: Column) -> Column:
    angle = F.degrees(F.atan2(F.lit(CENTRE_LON) - lon, F.lit(CENTRE_LAT) - lat))
    return F.when(angle < 0, angle + 360.0).otherwise(angle)


def seed_bearing(label: Column, lon: Column, lat: Column) -> Column:
    """Inbound counts face the centre, outbound ones away from it, others follow their label."""
    kind = direction_kind(label)
    inward = bearing_to_centre(lon, lat)
    known = lon.isNotNull() & lat.isNotNull()
    by_type = F.when(known & (kind == "in"), inward).when(
        known & (kind == "out"), F.pmod(inward + 180.0, F.lit(360.0))
    )
    return F.coalesce(by_type, label_bearing(label))


def arc_between(b1: Column, b2: Column) -> Column:
    """Smaller arc between two bearings; an unknown bearing counts as opposite (180)."""
    raw = F.pmod(F.abs(b1 - b2), F.lit(360.0))
    return F.coalesce(F.least(raw, 360.0 - raw), F.lit(180.0))


def arc_or_null(b1: Column, b2: Column) -> Column:
    """Smaller arc between two bearings; NULL when one is unknown."""
    return F.abs(F.pmod(b1 - b2 + 180.0, F.lit(360.0)) - 180.0)


def linear_weight(b1: Column, b2: Column, max_arc: float = 135.0) -> Column:
    """1 straight ahead, falling linearly to 0 at ``max_arc``; 0 for an unknown bearing."""
    return F.greatest(F.lit(0.0), 1.0 - arc_between(b1, b2) / max_arc)


def power_weight(b1: Column, b2: Column, max_arc: float, exponent: float) -> Column:
    """``(1 - arc/max)^exponent``, 0 from ``max_arc`` on; 1 when a bearing is unknown."""
    arc = arc_or_null(b1, b2)
    base = 1.0 - arc / max_arc
    return F.when(arc.isNull(), 1.0).when(arc >= max_arc, 0.0).otherwise(F.pow(base, F.lit(exponent)))


def comfort_weight(highway: Column, rules: tuple) -> Column:
    """1 plus the bonus of every rule that shares a value with the ``highway`` array."""
    weight = F.lit(1.0)
    for bonus, kinds in rules:
        hit = F.arrays_overlap(highway, F.array(*[F.lit(k) for k in kinds]))
        weight = weight + F.when(F.coalesce(hit, F.lit(False)), bonus).otherwise(0.0)
    return weight


def decay_per_100m(flow: Column, metres: Column, factor: float = 0.985) -> Column:
    return flow * F.pow(F.lit(factor), metres / 100.0)


def decay_per_metre(flow: Column, metres: Column, alpha: float) -> Column:
    return F.when(metres <= 0, flow).otherwise(flow * F.exp(metres * -alpha))
