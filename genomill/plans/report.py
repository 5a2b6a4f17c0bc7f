"""An HTML report of the tables that a run made, without any outside library."""

from __future__ import annotations

from html import escape
from itertools import combinations

from pyspark.sql import DataFrame

from . import figures

ROWS = 50
#: Rows that a figure takes at most; a longer table is shown by its first rows in order.
DRAWN = 5_000
HYBRID = ("fractions", "breed_scores", "mixture")
LARGE = ("genotypes", "analysis_genotypes", "callset", "qc_callset", "pseudohaploid", "treemix_input")


def captions(artifacts: dict) -> list[str]:
    """What the tables say, in a line each."""
    out = []
    if isinstance(artifacts.get("fst"), DataFrame):
        rows = [r for r in artifacts["fst"].collect() if r["fst"] is not None]
        if rows:
            a, b = max(rows, key=lambda r: r["fst"]), min(rows, key=lambda r: r["fst"])
            out.append(f"F_ST is largest between {a['pop1']} and {a['pop2']} ({a['fst']:.4f}), smallest between {b['pop1']} and {b['pop2']} ({b['fst']:.4f}).")
    if isinstance(artifacts.get("dstats"), DataFrame):
        rows = [r for r in artifacts["dstats"].collect() if r["z"] is not None]
        if rows:
            top = max(rows, key=lambda r: abs(r["z"]))
            out.append(f"{sum(abs(r['z']) > 3 for r in rows)} of {len(rows)} trios have |Z| > 3; the strongest is ({top['p1']}, {top['p2']}; {top['p3']}), Z = {top['z']:.2f}.")
    if cv := artifacts.get("admixture_cv"):
        ranked = sorted(cv.items(), key=lambda x: x[1])
        if len(ranked) > 1:
            margin = (ranked[1][1] - ranked[0][1]) / max(ranked[0][1], 1e-300)
            out.append(f"K = {ranked[0][0]} wins {'decisively' if margin > 0.05 else 'marginally'} ({100 * margin:.1f} %).")
    if isinstance(artifacts.get("roh"), DataFrame):
        rows = sorted(artifacts["roh"].collect(), key=lambda r: -r["f_roh"])
        if rows:
            out.append(f"F_ROH is largest in {rows[0]['sample_id']} ({rows[0]['f_roh']:.4f}); the median is {rows[len(rows) // 2]['f_roh']:.4f}.")
    if m := artifacts.get("mantel"):
        out.append(f"Mantel r = {m['r']:.4f}, p = {m['p']:.4f}.")
    return out


def badges(artifacts: dict, exploratory: bool) -> list[tuple[str, str, str]]:
    """(kind, label, detail): how far the run's results can be trusted."""
    out = [("warn", "Exploratory", "Read with the study's design and its filters.") if exploratory else ("ok", "Publication workflow", "Configured as such.")]
    if "diversity" in artifacts:
        callable_ = "callable_sites" in artifacts and artifacts["callable_sites"]
        out.append(("ok", "Callable sites given", "Diversity is per callable site.") if callable_ else ("warn", "Diversity relative to the panel", "Chosen sites are no denominator of a genome."))
    if any(r in artifacts for r in HYBRID):
        out.append(("warn", "Bridge-locus diagnostic", "Some hundreds of loci, not a genome."))
    if r := artifacts.get("readiness"):
        out.append(("warn" if r["warnings"] else "ok", f"Readiness: {len(r['warnings'])} warnings", "; ".join(r["warnings"])[:300] or "Autosomes, linkage, sample numbers and duplicates are checked."))
    if isinstance(artifacts.get("exclusions"), DataFrame):
        n = artifacts["exclusions"].count()
        out.append(("warn", f"{n} exclusions", "Each is in the table of exclusions.") if n else ("ok", "Quality gate passed", "Nothing was excluded."))
    else:
        out.append(("info", "No quality gate", "The recipe has no such stage."))
    return out


def drawings(artifacts: dict) -> dict[str, str]:
    """Figures by title, of the tables that are there."""
    def rows(role: str, *order: str) -> list:
        frame = artifacts.get(role)
        if not isinstance(frame, DataFrame):
            return []
        return (frame.orderBy(*order) if order else frame).limit(DRAWN).collect()

    out: dict[str, str] = {}
    sheet = {str(r["sample_id"]): r for r in rows("sample_sheet")}
    group = lambda s: (str(sheet[str(s)]["population"]),) if str(s) in sheet else ()
    if got := rows("pca", "sample_id"):
        out["Principal components"] = figures.points([(r["sample_id"], r["PC1"], r["PC2"], *group(r["sample_id"])) for r in got], "PC1", "PC2")
    if got := rows("fst"):
        out["F_ST"] = figures.heat([(str(r["pop1"]), str(r["pop2"]), r["fst"] or 0.0) for r in got])
    if got := rows("admixture", "sample_id"):
        out["Admixture"] = figures.stacked([(r["sample_id"], [r[c] for c in r.asDict() if c.startswith("Q")]) for r in got])
    if got := rows("distance"):
        names = sorted({str(x) for r in got for x in (r["s1"], r["s2"])})
        if len(names) * (len(names) - 1) // 2 == len(got):
            at, d = {n: i for i, n in enumerate(names)}, figures.np.zeros((len(names), len(names)))
            for r in got:
                i, j = at[str(r["s1"])], at[str(r["s2"])]
                d[i, j] = d[j, i] = r["distance"] or 0.0
            out["Clusters"] = figures.dendrogram(names, figures.merges_of(d))
    if got := rows("roh"):
        out["Runs of homozygosity"] = figures.bars([(r["sample_id"], r["f_roh"]) for r in sorted(got, key=lambda r: -r["f_roh"])])
    if any(r["latitude"] is not None for r in sheet.values()):
        out["Localities"] = figures.points([(s, r["longitude"], r["latitude"], str(r["population"])) for s, r in sheet.items()], "longitude", "latitude")
    if isinstance(artifacts.get("distance"), DataFrame) and isinstance(artifacts.get("places_km"), DataFrame):
        both = artifacts["distance"].join(artifacts["places_km"], ["s1", "s2"]).limit(DRAWN).collect()
        out["Isolation by distance"] = figures.points([(f"{r['s1']}, {r['s2']}", r["km"], r["distance"]) for r in both], "km", "genetic distance")
    if n := artifacts.get("nj"):
        out["Neighbour joining"] = figures.tree(n["newick"])
    if got := rows("fd_windows", "chrom", "start"):
        out["f_d along the genome"] = figures.scan([(str(r["chrom"]), r["start"], r["f_d"]) for r in got])
    if got := rows("ancestry_windows", "sample_id", "chrom", "start"):
        one = [r for r in got if r["sample_id"] == got[0]["sample_id"]]
        step = min((b["start"] - a["start"] for a, b in zip(one, one[1:], strict=False) if a["chrom"] == b["chrom"] and b["start"] > a["start"]), default=1)
        out[f"Local ancestry of {got[0]['sample_id']}"] = figures.karyogram([(str(r["chrom"]), r["start"], r["start"] + step, r["ancestry"]) for r in one])
    if got := rows("diversity", "population"):
        out["Diversity"] = figures.bars([(r["population"], r["pi"]) for r in got])
    if got := rows("fractions", "sample_id"):
        out["Source fractions"] = figures.bars([(r["sample_id"], r["fraction"]) for r in got])
    if got := rows("breed_scores", "sample_id", "rank"):
        out["Lead of the best panel on the pool"] = figures.bars([(r["sample_id"], r["gap"]) for r in got if r["rank"] == 1], marks=(5.0,))
        low = min(r["loglik"] for r in got)
        out["Ranking of panels"] = figures.bars([(f"{r['sample_id']} {r['panel']}", r["loglik"] - low) for r in got])
    if got := rows("mixture", "sample_id"):
        if "share_two" in got[0].asDict():
            out["Three-way shares"] = figures.points([(r["sample_id"], r["share_one"], r["share_two"], *([r["region"]] if "region" in r.asDict() else [])) for r in got], "first share", "second share")
    return {k: v for k, v in out.items() if v}


def html(artifacts: dict, title: str, exploratory: bool = True, cited: list[dict] = ()) -> str:
    parts = [f"<!doctype html><meta charset=utf-8><title>{escape(title)}</title><style>body{{font-family:sans-serif;margin:2em}}td,th{{padding:2px 8px;text-align:right}}.warn{{background:#f6e3c5}}.ok{{background:#d9ead3}}.info{{background:#e4e4e4}}.badge{{padding:2px 8px;margin-right:6px;border-radius:4px}}</style><h1>{escape(title)}</h1>"]
    parts.append("<p>" + "".join(f'<span class="badge {kind}" title="{escape(detail)}">{escape(label)}</span>' for kind, label, detail in badges(artifacts, exploratory)) + "</p>")
    if exploratory:
        parts.append("<p><b>Exploratory.</b> Results are relative to the panel and its filters.</p>")
    parts += [f"<p>{escape(c)}</p>" for c in captions(artifacts)]
    parts += [f"<h2>{escape(k)}</h2>{v}" for k, v in drawings(artifacts).items()]
    for role in sorted(artifacts):
        v = artifacts[role]
        if role in LARGE:
            continue
        if isinstance(v, DataFrame):
            rows = v.limit(ROWS).collect()
            head = "".join(f"<th>{escape(c)}</th>" for c in v.columns)
            body = "".join("<tr>" + "".join(f"<td>{escape(f'{x:.6g}' if isinstance(x, float) else str(x))}</td>" for x in r) + "</tr>" for r in rows)
            parts.append(f"<h2>{escape(role)}</h2><table><tr>{head}</tr>{body}</table>")
        else:
            parts.append(f"<h2>{escape(role)}</h2><pre>{escape(str(v)[:5000])}</pre>")
    if cited:
        link = lambda s: f'<a href="{escape(s["link"])}">{escape(s["label"])}</a>' if s["link"] else escape(s["label"])
        body = "".join(f"<tr><td>{escape(s['dataset'])}</td><td>{link(s)}</td>" + "".join(f"<td>{escape(str(s[f] or ''))}</td>" for f in ("study", "year", "accession", "used_for", "access")) + "</tr>" for s in cited)
        parts.append(f"<h2>Sources</h2><table>{body}</table>")
    return "\n".join(parts)


def farthest(means: dict[str, float]) -> tuple[str, str, float]:
    """The pair of groups whose means are farthest apart."""
    return max(((a, b, abs(means[a] - means[b])) for a, b in combinations(sorted(means), 2)), key=lambda x: x[2])
