"""The ordered rank domain and the spellings of ranks and statuses that sources use."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rank labels, highest first; a label's ordinal is its place.
RANKS = (
    "KINGDOM SUBKINGDOM PHYLUM SUBPHYLUM CLASS SUBCLASS ORDER SUBORDER FAMILY SUBFAMILY TRIBE SUBTRIBE GENUS SUBGENUS SECTION "
    "SUBSECTION SERIES SUBSERIES SPECIES GREX SUBSPECIES VARIETY SUBVARIETY FORM SUBFORM LUSUS CULTIVAR COMPLEX UNRANKED"
).split()

# Spellings of each rank and status.
RANK_SPELLINGS = {
    "kingdom": ["kingdom", "regn.", "domain"],
    "subkingdom": ["subkingdom", "subregn."],
    "phylum": ["division", "div.", "phylum", "superphylum"],
    "subphylum": ["subdivision", "subdiv.", "subdivf.", "subphylum", "cohort"],
    "class": ["class", "cl.", "superclass"],
    "subclass": ["subclass", "subcl.", "infraclass"],
    "order": ["order", "ordo", "superorder"],
    "suborder": ["suborder", "subordo", "infraorder", "parvorder"],
    "family": ["family", "fam.", "superfamily"],
    "subfamily": ["subfamily", "subfam."],
    "tribe": ["tribe", "trib.", "tr.", "supertribe", "supertrib."],
    "subtribe": ["subtribe", "subtr.", "subtrib.", "nothosubtrib.", "supersubtribe", "supersubtrib."],
    "genus": ["genus", "gen.", "genitor"],
    "subgenus": ["subgenus", "subg.", "subgen.", "nothosubgen.", "subgenitor", "microgen.", "microgène", "microgene", "genushybrid"],
    "section": ["section", "sect.", "nothosect.", "grex_sect.", "section botany", "supersection", "supersect.", "suprasect."],
    "subsection": ["subsection", "subsect.", "nothosubsect."],
    "series": ["series", "ser.", "nothoser.", "gen. ser.", "superseries", "superser."],
    "subseries": ["subseries", "subser."],
    "species": ["species", "spec.", "agamosp.", "psp.", "sp.", "nothosp.", "sp", "ichnospecies", "aff.", "cf.", "mad.", "s."],
    "grex": ["grex", "[infragen.grex]", "infragen.grex", "nothogrex"],
    "subspecies": ["subspecies", "subsp.", "subspec.", "ssp.", "nothosubsp.", "subspecioid", "subspecies (plantae)", "subsubsp."],
    "variety": ["variety", "var.", "nothovar.", "convariety", "convar.", "agamovar.", "prol.", "proles", "provar.", "[beta].", "*", "infrahybrid", "hybrid", "pseudovar.", "var", "varietas"],
    "subvariety": ["subvariety", "subvar.", "subsubvar.", "stirps", "linea", "subhybr.", "subproles", "race"],
    "form": ["form", "f.", "fo.", "f.sp.", "forma", "nothof.", "mut.", "modif.", "cycl.", "ap.", "oec.", "nm.", "monstr.", "micromorphe", "ecas.", "mod.", "forma specialis", "morph"],
    "subform": ["subform", "subf.", "subfo.", "subsubforma", "microf.", "subsubf.", "strain"],
    "lusus": ["lusus", "lus.", "sublus.", "sublusus"],
    "cultivar": ["cultivar", "cult."],
    "complex": ["complex", "gruppe", "group", "agglom.", "nid", "species group", "species subgroup", "pathogroup"],
    "unranked": ["unranked", "[unranked]", "[infragen.unranked]", "[infrasp.unranked]", "[infragen.]", "[infragen]", "[infrafam.unranked]", "positio", "-", "no rank"],
}
STATUS_SPELLINGS = {
    "accepted": ["accepted", "provisionally accepted", "legitimate"],
    "edgecase": ["artificial hybrid", "local biotype"],
    "unplaced": ["unchecked", "unplaced", "uncertain"],
    "synonym": ["synonym", "heterotypic synonym", "heterotypic_synonym", "homotypic synonym", "homotypic_synonym", "proparte synonym"],
    "problematic": ["doubtful", "illegitimate", "invalid", "orthographic", "misapplied", "orthographic variant", "unavailable", "deleted"],
}
HYBRID_RANKS = ["genushybrid", "hybrid", "infrahybrid", "subhybr.", "grex", "[infragen.grex]", "infragen.grex", "grex_sect."]


def spelled(value: Column, spellings: dict[str, list[str]]) -> Column:
    """The label that lists ``value`` (any case) as a spelling, else null; one hash lookup a row."""
    pairs = {word: label for label, words in spellings.items() for word in words}
    lookup = F.create_map(*map(F.lit, chain.from_iterable(pairs.items())))
    return F.try_element_at(lookup, F.lower(value))


def rank_label(value: Column) -> Column:
    return spelled(value, RANK_SPELLINGS)


def status_label(value: Column) -> Column:
    return spelled(value, STATUS_SPELLINGS)


def rank_ordinal(label: Column) -> Column:
    """Place of a rank label (any case) in the order, null if it is none."""
    lookup = F.create_map(*map(F.lit, chain.from_iterable((r, i) for i, r in enumerate(RANKS))))
    return F.try_element_at(lookup, F.upper(label))
