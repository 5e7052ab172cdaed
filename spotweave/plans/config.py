"""Recipes, sheets, their checks, and the files and targets a recipe implies."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spotweave.operators.reads import Element

# The columns of a recipe sheet.
RECIPE_COLUMNS = ["R1_finalLength", "fwd_primer", "rev_primer", "BC_adapter", "BC_length", "BC_offset", "BC_position", "BC_max_ED", "BC_min_ED_diff", "BC_concat", "UMI_adapter", "UMI_length", "UMI_offset", "UMI_position", "internal_adapter", "STAR_soloType", "STAR_soloCBmatchWLtype", "STAR_soloCB", "STAR_soloUMI", "STAR_soloAdapter", "STAR_extra", "kb_x", "kb_extra", "featureCounts_extra", "mm2_extra"]
INTEGER_COLUMNS = ["BC_length", "BC_offset", "BC_max_ED", "BC_min_ED_diff", "UMI_length", "UMI_offset"]


def cells(value: str) -> list[str]:
    """A cell's list, by blanks."""
    return (value or "").split()


def truth(value: str) -> bool:
    return str(value).strip().lower() in ("true", "1")


def spread(values: list, n: int) -> list:
    """A list of one repeated n times."""
    if len(values) not in (1, n):
        raise ValueError(f"{len(values)} values for {n} elements")
    return list(values) * n if len(values) == 1 else list(values)


def greatest_sum(entries: list[str]) -> int:
    """The largest sum of a cell's integers."""
    return max((sum(map(int, cells(e))) for e in entries), default=0)


@dataclass
class Recipe:
    name: str
    barcodes: list[Element] = field(default_factory=list)
    umis: list[Element] = field(default_factory=list)
    max_dist: list[int] = field(default_factory=lambda: [2])
    min_margin: list[int] = field(default_factory=lambda: [1])
    concat: bool = False
    internal_adapter: str = ""
    fwd_primer: str = ""
    rev_primer: str = ""
    r1_length: int = 0
    extra: dict[str, str] = field(default_factory=dict)

    @classmethod
    def from_row(cls, row: dict[str, str]) -> Recipe:
        def elements(kind: str) -> list[Element]:
            anchors, lengths = cells(row[f"{kind}_adapter"]), cells(row[f"{kind}_length"])
            n = max(len(anchors), len(lengths))
            if not n:
                return []
            offsets = spread(cells(row.get(f"{kind}_offset", "")) or ["0"], n)
            sides = spread(cells(row.get(f"{kind}_position", "")) or ["right"], n)
            return [Element(int(a) if a.isdigit() else a, int(k), int(o), s) for a, k, o, s in zip(spread(anchors, n), spread(lengths, n), offsets, sides, strict=True)]

        ints = lambda c, default: [int(v) for v in cells(row.get(c, ""))] or default
        known = {"recipe", "BC_concat", *RECIPE_COLUMNS[:15]}
        return cls(
            row["recipe"], elements("BC"), elements("UMI"), ints("BC_max_ED", [2]), ints("BC_min_ED_diff", [1]), truth(row.get("BC_concat", "")),
            row.get("internal_adapter", ""), row.get("fwd_primer", ""), row.get("rev_primer", ""), int(row.get("R1_finalLength") or 0), {k: v for k, v in row.items() if k not in known},
        )


#: Chemistries whose values are known.
KNOWN = {
    "visium": Recipe("visium", [Element(0, 16)], [Element(16, 12)]),
    "visium_ont": Recipe("visium_ont", [Element("CTACACGACGCTCTTCCGATCT", 16)], [Element("CTACACGACGCTCTTCCGATCT", 12, 16)]),
    "seeker": Recipe("seeker", [Element("TCTTCAGCGTTCCCGAGA", 8, 0, "left"), Element("TCTTCAGCGTTCCCGAGA", 6)], [Element("TCTTCAGCGTTCCCGAGA", 7, 6)], concat=True),
    "microST": Recipe("microST", [Element("TGATGCCACACTGA", 10, 0, "left"), Element("TGATGCCACACTGA", 10)], [Element("CTACACGACGCTCTTCCGATCT", 12)]),
}


def check_recipes(rows: list[dict[str, str]]) -> list[str]:
    """Warnings; raises for values that can't be used."""
    missing = [c for c in RECIPE_COLUMNS if rows and c not in rows[0]]
    warnings = [f"recipe sheet lacks {c}" for c in missing]
    for name, n in Counter(r["recipe"] for r in rows).items():
        if n > 1:
            raise ValueError(f"recipe {name} comes {n} times")
    for r in rows:
        for c in INTEGER_COLUMNS:
            if any(not v.lstrip("-").isdigit() for v in cells(r.get(c, ""))):
                raise ValueError(f"recipe {r['recipe']}: {c} isn't integers: {r[c]}")
        if r.get("BC_concat", "") and str(r["BC_concat"]).lower() not in ("true", "false", "1", "0"):
            raise ValueError(f"recipe {r['recipe']}: BC_concat is {r['BC_concat']}")
        warnings += [f"recipe {r['recipe']}: no {c}" for c in ("BC_adapter", "BC_length", "UMI_adapter", "UMI_length") if not r.get(c)]
    return warnings


def check_samples(rows: list[dict[str, str]], recipes: set[str], exists=None) -> list[str]:
    """Warnings; only files that are missing, as ``exists`` tells, raise."""
    warnings, lost = [], []
    for name, n in Counter(r["sampleID"] for r in rows).items():
        if n > 1:
            warnings.append(f"sample {name} comes {n} times")
    for r in rows:
        short, long = cells(r.get("recipe", "")), cells(r.get("recipe_ONT", ""))
        warnings += [f"{r['sampleID']}: unknown recipe {x}" for x in short + long if x not in recipes]
        needed = [c for c, on in (("fastq_R1", short), ("fastq_R2", short), ("ONT", long), ("BC_map", short or long)) if on]
        warnings += [f"{r['sampleID']}: no {c}" for c in needed if not r.get(c)]
        if len(cells(r.get("fastq_R1", ""))) != len(cells(r.get("fastq_R2", ""))):
            warnings.append(f"{r['sampleID']}: R1 and R2 differ in number")
        files = [f for c in needed for f in cells(r.get(c, ""))]
        warnings += [f"{r['sampleID']}: {f} isn't compressed FASTQ" for c in ("fastq_R1", "fastq_R2") for f in cells(r.get(c, "")) if not f.endswith(("fq.gz", "fastq.gz"))]
        lost += [f for f in files if exists and not exists(f)]
    if lost:
        raise FileNotFoundError(", ".join(lost))
    return warnings


#: Chemistries whose long reads need a transcriptome, and whose recipes need lengths.
SPATIAL = ["visium", "seeker", "stomics", "decoder", "miST"]


def check_all(samples: list[dict[str, str]], recipes: list[dict[str, str]], whitelist_lengths: dict[str, int] | None = None, exists=None) -> list[str]:
    """Every check at once: sheets, files, recipes against whitelists, and samples against recipes.

    Returns the warnings; what can't be run (a transcriptome or lengths that are missing) is raised together.
    """
    known = {r["recipe"]: r for r in recipes}
    warnings = check_recipes(recipes) + check_samples(samples, set(known), exists)
    for name, length in (whitelist_lengths or {}).items():
        if name in known:
            warnings += check_compatible(Recipe.from_row(known[name]), length)
    wrong = []
    for r in samples:
        short, long = cells(r.get("recipe", "")), cells(r.get("recipe_ONT", ""))
        if not str(r.get("cdna_fa") or "").strip():
            wrong += [f"{r['sampleID']}: rRNA-bwa needs cdna_fa"] * ("rRNA-bwa" in short)
            wrong += [f"{r['sampleID']}: {x} for long reads needs cdna_fa" for x in long if x in SPATIAL]
        wrong += [f"{r['sampleID']}: {x} has no {c}" for x in short if x in SPATIAL and x in known for c in ("BC_length", "UMI_length") if not str(known[x].get(c) or "").strip()]
    if wrong:
        raise ValueError("; ".join(wrong))
    return warnings


def duplicates(sheet: DataFrame, key: str) -> DataFrame:
    return sheet.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def check_compatible(recipe: Recipe, wl_length: int) -> list[str]:
    """Whether a recipe's barcodes can be looked up in entries of a whitelist."""
    total = sum(e.length for e in recipe.barcodes)
    out = [] if not recipe.concat or total == wl_length else [f"{recipe.name}: barcodes of {total} for entries of {wl_length}"]
    return out + [f"{recipe.name}: {a} and {b} differ in number" for a, b in (("BC", "max_dist"),) if len(recipe.max_dist) not in (1, len(recipe.barcodes))]


def strategy(recipe: Recipe) -> str:
    return "split" if len(recipe.barcodes) > 1 and not recipe.concat else "single"


def whitelist_files(recipe: str, concat: bool, mode: str) -> list[str]:
    """The whitelists of a recipe, by parts of its name; the first rule that fits."""
    if "internalTrim" in recipe or "hardTrim" in recipe:
        return ["whitelist.txt"]
    if "adapterInsert" in recipe:
        return ["whitelist_adapter.txt"]
    if "matchLinker" in recipe or "seeker_std" in recipe:
        if concat:
            return ["whitelist.txt"] if mode == "ONT" else ["whitelist_1.txt", "whitelist_2.txt"]
        return ["whitelist_uniq_1.txt", "whitelist_uniq_2.txt"]
    return ["whitelist.txt"]


def read_branch(recipe: str) -> tuple[str, str]:
    """(rRNA filter, trimming) by parts of a recipe's name."""
    rrna = "bwa" if "rRNA-bwa" in recipe else "ribodetector" if "ribodetector" in recipe else "none"
    trim = "internal" if "internalTrim" in recipe else "hard" if "hardTrim" in recipe else "none"
    return rrna, trim


def sample_recipes(sheet: DataFrame, column: str = "recipe") -> DataFrame:
    """(sampleID, recipe): one row for each recipe in a cell."""
    return sheet.select("sampleID", F.explode(F.filter(F.split(column, r"\s+"), lambda x: x != "")).alias("recipe"))


def targets(pairs: DataFrame, kinds: list[str]) -> DataFrame:
    """Every output of every sample and recipe."""
    return pairs.select("*", F.explode(F.array(*[F.lit(k) for k in kinds])).alias("kind"))


def lookup(pairs: DataFrame, recipes: DataFrame) -> DataFrame:
    """Recipe parameters of each pair; the sheet of recipes is a small dimension."""
    return pairs.join(recipes, "recipe", "left")
