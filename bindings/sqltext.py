"""SQL snippets shared by the oracles. They restate the rules independently of the library."""

from __future__ import annotations


def rnd(x: str, digits: int = 0) -> str:
    f = 10**digits
    return f"(floor(({x}) * {f}.0::double + 0.5::double) / {f}.0::double)"


def curve(x: str, anchors) -> str:
    pts = sorted(anchors)
    arms = [f"when ({x}) is null then null", f"when ({x}) <= {pts[0][0]}::double then {pts[0][1]}::double",
            f"when ({x}) >= {pts[-1][0]}::double then {pts[-1][1]}::double"]
    for (a, b), (c, d) in zip(pts, pts[1:]):
        arms.append(
            f"when ({x}) <= {c}::double then greatest(0::double, least(100::double, {b}::double + "
            f"((({x})::double - {a}::double) / {c - a}::double) * {d - b}::double))"
        )
    return "(case " + " ".join(arms) + " end)"


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"pow(sin(radians({lon2} - {lon1}) / 2), 2) * cos(radians({lat1})) * cos(radians({lat2}))"
    )
    return f"(2 * 6371000.0::double * asin(case when {h} > 1 then 1.0::double else sqrt({h}) end))"


def joined(pairs: list[tuple[str, str]]) -> str:
    """Comma list of the names whose condition holds, in order."""
    parts = ", ".join(f"case when {cond} then '{name}' end" for name, cond in pairs)
    return f"concat_ws(',', {parts})"
