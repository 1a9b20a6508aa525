"""Enzyme and motif dimensions: small fixed tables that specialise the plans on the driver."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_COMPLEMENT = str.maketrans("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN")
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}

# Id, name, recognition site as N-count or IUPAC letters, unit length of a concatenated tag,
# inclusive 0-based windows of the five tags in a merged read.
_ENZYMES = (
    (1, "CspCI", "N11 CAA N5 GTGG N10", 38, ((0, 55), (37, 92), (75, 130), (113, 168), (151, 215))),
    (2, "AloI", "N7 GAAC N6 TCC N7", 39, ((0, 49), (38, 87), (77, 126), (116, 165), (155, 220))),
    (3, "BsaXI", "N9 AC N5 CTCC N7", 33, ((0, 49), (32, 81), (65, 114), (98, 147), (131, 190))),
    (4, "BaeI", "N10 AC N4 GTAYC N7", 38, ((0, 50), (37, 87), (75, 125), (113, 163), (151, 215))),
    (5, "BcgI", "N10 CGA N6 TGC N10", 36, ((0, 54), (35, 89), (71, 125), (107, 161), (143, 205))),
    (6, "CjeI", "N8 CCA N6 GT N9", 40, ((0, 50), (39, 89), (79, 129), (119, 169), (159, 225))),
    (7, "PpiI", "N7 GAAC N5 CTC N8", 37, ((0, 49), (36, 85), (73, 122), (110, 159), (147, 210))),
    (8, "PsrI", "N7 GAAC N6 TAC N7", 37, ((0, 49), (36, 85), (73, 122), (110, 159), (147, 210))),
    (9, "BplI", "N8 GAG N5 CTC N8", 37, ((0, 49), (36, 85), (73, 122), (110, 159), (147, 210))),
    (10, "FalI", "N8 AAG N5 CTT N8", 37, ((0, 49), (36, 85), (73, 122), (110, 159), (147, 210))),
    (11, "Bsp24I", "N8 GAC N6 TGG N7", 37, ((0, 49), (36, 85), (73, 122), (110, 159), (147, 210))),
    (12, "HaeIV", "N7 GAY N5 RTC N9", 38, ((0, 49), (37, 86), (75, 124), (113, 162), (151, 215))),
    (13, "CjePI", "N7 CCA N7 TC N8", 39, ((0, 49), (38, 87), (77, 126), (116, 165), (155, 220))),
    (14, "Hin4I", "N8 GAY N5 VTC N8", 37, ((0, 49), (36, 85), (73, 122), (110, 159), (147, 210))),
    (15, "AlfI", "N10 GCA N6 TGC N10", 36, ((0, 54), (35, 89), (71, 125), (107, 161), (143, 205))),
    (16, "BslFI", "N6 GGGAC N14", 34, ((0, 47), (33, 80), (67, 114), (101, 148), (135, 195))),
)


def reverse_complement(sequence: str) -> str:
    return sequence.translate(_COMPLEMENT)[::-1]


def motif_regex(motif: str) -> str:
    """IUPAC letters as a regex; runs of the same letter are counted."""
    out, i = [], 0
    while i < len(motif):
        j = i
        while j < len(motif) and motif[j] == motif[i]:
            j += 1
        letters = IUPAC[motif[i]]
        out.append((letters if len(letters) == 1 else f"[{letters}]") + (f"{{{j - i}}}" if j - i > 1 else ""))
        i = j
    return "".join(out)


def anchored_regex(site: str) -> str:
    """A Java regex whose group 1 is a hit, found by the first letter of the site that isn't N.

    Only that letter is consumed, so overlapping hits are found; flanks are tried where it stands, not at
    every place, and the hit is taken from its start by a look-ahead inside the look-behind.
    """
    k = next(i for i, c in enumerate(site) if c != "N")
    letter = motif_regex(site[k])
    return f"{letter}(?={motif_regex(site[k + 1:])})(?<=(?=(.{{{len(site)}}})){motif_regex(site[:k])}{letter})"


@dataclass(frozen=True)
class Enzyme:
    id: int
    name: str
    site: str
    unit: int
    windows: tuple[tuple[int, int], ...]

    @property
    def length(self) -> int:
        return len(self.site)

    @property
    def palindromic(self) -> bool:
        return self.site == reverse_complement(self.site)

    @property
    def forward(self) -> str:
        return motif_regex(self.site)

    @property
    def reverse(self) -> str:
        return motif_regex(reverse_complement(self.site))

    @property
    def patterns(self) -> tuple[str, ...]:
        return (self.forward,) if self.palindromic else (self.forward, self.reverse)

    @property
    def anchored(self) -> tuple[str, ...]:
        """``patterns`` for scans of long sequences in Spark."""
        return tuple(map(anchored_regex, (self.site,) if self.palindromic else (self.site, reverse_complement(self.site))))

    @property
    def expected(self) -> int:
        """Length of five concatenated units with four 3-nt linkers; merged reads may differ by 15."""
        return 5 * self.unit + 4 * 3


def _expand(site: str) -> str:
    return "".join("N" * int(part[1:]) if part[0] == "N" and part[1:].isdigit() else part for part in site.split())


ENZYMES = tuple(
    Enzyme(i, name, _expand(site), unit, windows)
    for i, name, site, unit, windows in _ENZYMES
)


def select(which: int | str = 13) -> tuple[Enzyme, ...]:
    """Enzymes by id, by name in any case, or all of them by 17 or ``all``."""
    if str(which).lower() in ("17", "all"):
        return ENZYMES
    for e in ENZYMES:
        if str(which).lower() in (str(e.id), e.name.lower()):
            return (e,)
    raise ValueError(f"unknown enzyme {which!r}")


def enzyme_table(spark: SparkSession) -> DataFrame:
    rows = [(e.id, e.name, e.length, list(e.patterns), e.palindromic, e.unit, e.expected, list(e.windows)) for e in ENZYMES]
    return spark.createDataFrame(
        rows,
        "id int, name string, length int, patterns array<string>, palindromic boolean, unit int, expected int, "
        "windows array<struct<start:int,end:int>>",
    )


@dataclass(frozen=True)
class Motif:
    enzyme: str
    context: str
    motif: str
    start: int
    left: int
    right: int
    shift: int = 0
    both: bool = False

    @property
    def length(self) -> int:
        return self.left + len(self.motif) + self.right


# Methylation presets (enzyme, context, motif, 1-based motif start, left and right flank, shift, both strands).
MOTIFS = (
    Motif("MspJI", "CpG", "YNCGNR", 14, 13, 13),
    Motif("MspJI", "CHG", "YCHGR", 14, 13, 13, 0, True),
    Motif("AspBHI", "CpG", "YSCGSR", 14, 13, 13),
    Motif("AspBHI", "CHG", "YNCHGNR", 13, 12, 12, 1, True),
    Motif("RlaI", "CHG", "VCWGB", 14, 13, 13, 1),
    Motif("SgrTI", "CpG", "SCGS", 15, 14, 14),
    Motif("SgrTI", "CHG", "BCWGV", 14, 13, 13, 1),
    Motif("FspEI", "CpG", "CCGG", 15, 14, 14),
    Motif("FspEI", "CHG", "CCWGG", 14, 13, 13, 1),
)


def motif(enzyme: str = "MspJI", context: str = "CpG") -> Motif:
    for m in MOTIFS:
        if (m.enzyme.lower(), m.context.lower()) == (enzyme.lower(), context.lower()):
            return m
    raise ValueError(f"no preset for {enzyme} {context}")
