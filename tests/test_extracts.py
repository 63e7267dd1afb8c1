"""Each source's extract on a few hand-made rows of its raw files."""

import json

import pytest

from amalgam.sources import extracts

CODES = {"deu": "de", "eng": "en", "fra": "fr"}


def frame(spark, text, **casts):
    """A frame from lines of comma-separated cells (first line: names); empty cells are null."""
    head, *rows = [[c.strip() for c in line.split(",")] for line in text.strip().split("\n")]
    cells = [[casts.get(n, str)(c) if c else None for n, c in zip(head, r, strict=True)] for r in rows]
    kinds = {int: "long", str: "string"}
    return spark.createDataFrame(cells, ", ".join(f"`{n}` {kinds[casts.get(n, str)]}" for n in head))


def by_id(df, key="id_raw"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}


def test_ipni(spark):
    names = frame(spark, "col:ID,col:scientificName,col:authorship,col:rank,col:publishedInYear,col:referenceID\n1-1,Rosa dc. alba,L.,spec.,71997,r1\n2-1,Quercus var. rubra,,var.,1800,\n3-1,[],,,x,")
    taxa = frame(spark, "col:nameID,col:family\n1-1,ROSACEAE\n2-1,Fagaceae")
    relations = frame(spark, "col:nameID,col:relatedNameID,col:type\n1-1,9-1,basionym\n1-1,8-1,homonym")
    references = frame(spark, "col:ID,col:title,col:remarks\nr1,Species Plantarum,see [BHL_TITLE_ID:12] [bhl_page_id:345]")
    got = by_id(extracts.ipni(names, taxa, relations, references))
    assert set(got) == {"1-1", "2-1"}
    one = got["1-1"]
    assert (one["name_clean"], one["year"], one["family"], one["rank_clean"], one["bhl_title"], one["bhl_page"], one["publication"]) == ("rosa alba", 1997, "rosaceae", "species", 12, 345, "Species Plantarum")
    assert one["synonyms"] == [{"id": "8-1", "type": "homonym"}, {"id": "9-1", "type": "basionym"}]
    assert got["2-1"]["name_clean"] == "quercus rubra" and got["2-1"]["synonyms"] is None


def test_wcvp(spark):
    names = frame(spark, "plant_name_id,taxon_name,taxon_rank,family,genus,species,genus_hybrid,species_hybrid,hybrid_formula,parent_plant_name_id,primary_author,taxon_status,place_of_publication,first_published,reviewed,ipni_id,powo_id,lifeform_description\n1,Mentha × piperita,Species,Lamiaceae,Mentha,piperita,,×,,,L.,Accepted,Sp. Pl.: 576,(1753),Y,i1,p1,perennial or rhizome\n2,Poa annua,Species,Poaceae,Poa,annua,,,,,L.,Synonym,,n.d.,N,,,annual")
    distribution = frame(spark, "plant_name_id,area_code_l3,region_code_l2,continent_code_l1,introduced\n1,GER,11,1,0\n1,,12,1,0\n1,FRA,,,1", introduced=int)
    got = by_id(extracts.wcvp(names, distribution))
    mint = got["1"]
    assert (mint["name_clean"], mint["hybrid"], mint["hybrid_type"], mint["year"], mint["reviewed"], mint["perennial"], mint["annual"]) == ("mentha piperita", True, "species", 1753, True, True, False)
    assert mint["native_to"] == ["12", "ger"] and mint["regions"] == ["12", "fra", "ger"] and mint["accepted"]
    assert got["2"]["year"] is None and got["2"]["synonym"] and got["2"]["regions"] is None


def test_powo(spark):
    cols = "taxonID,scientificName,verbatimTaxonRank,kingdom,phylum,class,order,family,genus,parentNameUsageID,scientificNameAuthorship,taxonomicStatus,namePublishedIn,namePublishedInYear,source"
    taxa = frame(spark, cols + "\nurn:lsid:ipni.org:names:1-1,Rosa canina subsp. alba,subsp.,Plantae,,,,Rosaceae,Rosa,urn:lsid:ipni.org:names:2-1, L. ,Accepted,Sp. Pl. 2 (1): 576,1753-05,wcvp:77")
    life = taxa.withColumn("dynamicProperties", extracts.F.lit('{"lifeform": "annual"}'))
    got = by_id(extracts.powo(life))["1-1"]
    assert (got["name_clean"], got["parent_raw"], got["publication_short"], got["year"], got["wcvp_id"], got["annual"], got["perennial"]) == ("rosa canina alba", "2-1", "Sp. Pl.", 1753, "77", True, False)


def test_wfo(spark):
    cols = "taxonID,scientificName,taxonRank,family,genus,parentNameUsageID,scientificNameAuthorship,taxonomicStatus,scientificNameID,namePublishedIn,tropicosId,doNotProcess_reason\n"
    rows = "w1,Rosa alba,species,Rosaceae,Rosa,,L.,Accepted,urn:lsid:ipni.org:names:1-2,in: Sp. Pl. 4: 10 (1753),,\nw2,Rosa x,species,,,,,,,,,bad\nw3,#NAME?,species,,,,,,,,,\nw4,Poa annua,species,,,,#REF!,,4711,,,"
    references = frame(spark, "taxonID,relation\nw1,http://x/BHL.title.99\nw1,http://x/bhl.title.5\nw4,other")
    got = by_id(extracts.wfo(frame(spark, cols + rows), references))
    assert set(got) == {"w1", "w4"}
    assert (got["w1"]["ipni_id"], got["w1"]["tropicos_id"], got["w1"]["year"], got["w1"]["publication_short"], got["w1"]["bhl_title"]) == ("1-2", None, 1753, "Sp. Pl.", 5)
    assert got["w4"]["author_raw"] is None and got["w4"]["tropicos_id"] == 4711


def test_tropicos(spark):
    cols = "taxonID,scientificName,scientificNameAuthorship,kingdom,family,genus,year\n"
    a = frame(spark, cols + "1,Rosa alba L.,L.,Plantae,Rosaceae,Rosa,1900\n1,Rosa alba L.,L.,Plantae,Rosaceae,Rosa,1850\n2,Rosa,,Plantae,,,")
    b = frame(spark, cols + "3,Poa st. annua var. minor,,Plantae,,,1800\n4,Poa st. annua,,Plantae,,,\n1,Rosa alba L.,L.,Plantae,Rosaceae,Rosa,1799")
    got = by_id(extracts.tropicos(a, b))
    assert {k: (v["rank_raw"], v["year"]) for k, v in got.items()} == {1: ("species", 1799), 2: ("genus", None), 3: ("var.", 1800), 4: (None, None)}
    assert got[1]["name_clean"] == "rosa alba" and got[3]["rank_clean"] == "variety"


def test_fungorum(spark):
    names = frame(spark, "ID,scientificName,authorship,rank\n1,Amanita muscaria,Fr.,sp.\n2,Boletus,,gen.")
    taxa = frame(spark, "ID,kingdom,phylum,class,order,family,genus,species,parentID\n1,Fungi,Basidiomycota,,,Amanitaceae,Amanita,muscaria,7")
    synonyms = frame(spark, "taxonID,nameID,status\n1,5,synonym\n1,4,synonym", taxonID=int)
    references = frame(spark, "ID,source,year\n1,in Syst. mycol. 1: 16,1821")
    got = by_id(extracts.fungorum(names, taxa, synonyms, references))
    assert (got[1]["kingdom"], got[1]["parent_raw"], got[1]["publication_short"], got[1]["year"], [x["id"] for x in got[1]["synonyms"]]) == ("fungi", "7", "Syst. mycol.", 1821, ["4", "5"])
    assert got[2]["kingdom"] is None and got[2]["rank_clean"] == "genus"


def test_mycobank(spark):
    rows = [(1, 10, "Fungi", "Fungi"), (2, 20, "Agaricales", "Fungi, Agaricales"), (3, 30, "Amanita", "Fungi, Agaricales, Agaricales"), (4, 40, "Agaricales", "Animals, Agaricales"), (5, 50, "Lone", "-"), (6, 60, "Boletus", "Fungi, Nowhere")]
    names = spark.createDataFrame([(i, b, n, "F.", "gen.", "1821 [1822]", "Legitimate", c) for i, b, n, c in rows], "ID long, `MycoBank #` long, `Taxon name` string, `Authors (abbreviated)` string, Rank string, `Year of effective publication` string, `Name status` string, Classification string")
    got = by_id(extracts.mycobank(names))
    assert {k: v["parent_raw"] for k, v in got.items()} == {10: None, 20: None, 30: 20, 40: None, 50: None, 60: None}
    assert got[30]["year"] == 1821 and got[30]["accepted"]


def test_gbif(spark):
    taxa = spark.createDataFrame(
        [("1", "Rosa alba L., 1753", None, None, "L., 1753", "SPECIES", "Plantae", "accepted"), ("2", "Rosa nigra Mill.", "9", "1", "Mill.", "SPECIES", "Plantae", "synonym"), ("3", "Felis", None, None, None, "GENUS", "Animalia", "accepted")],
        "taxonID string, scientificName string, parentNameUsageID string, acceptedNameUsageID string, scientificNameAuthorship string, taxonRank string, kingdom string, taxonomicStatus string",
    ).selectExpr("*", "'' phylum", "'' `class`", "'' `order`", "'' family", "'' genus")
    distribution = frame(spark, "taxonID,locationID,countryCode,establishmentMeans\n1,TDWG:GER-OO,,native\n1,,FR,introduced\n1,,FRA,native\n2,,DE,")
    vernacular = spark.createDataFrame([("1", "deu", "Weiße Rose; Rosenstock"), ("1", None, "x"), ("1", "xx", "white rose")], "taxonId string, language string, vernacularName string")
    got = by_id(extracts.gbif(taxa, distribution, vernacular, CODES))
    assert set(got) == {1, 2}
    assert (got[1]["name_clean"], got[1]["author_raw"], got[1]["year"], got[1]["native_to"], got[1]["regions"]) == ("rosa alba", "L.", 1753, ["ger"], ["fr", "ger"])
    assert got[1]["vernacular"] == ["de:Rosenstock", "de:Weiße Rose", "xx:white rose"] and got[2]["accepted_raw"] == 1 and got[2]["year"] is None


def test_col(spark):
    names = "ID scientificName parentID authorship rank kingdom phylum subphylum class subclass order family subfamily genus species combinationAuthorshipYear notho status extinct link nameReferenceID".split()
    row = dict(ID="a", scientificName="Rosa × alba", rank="species", kingdom="Plantae", combinationAuthorshipYear="1760", notho="specific", status="accepted", extinct="false", link="https://www.tropicos.org/name/27", nameReferenceID="r1")
    other = dict(ID="b", scientificName="Poa annua", rank="species", kingdom="Plantae", combinationAuthorshipYear="1761", status="accepted", link="https://list.worldfloraonline.org/wfo-0001-2024-06")
    usages = spark.createDataFrame([[r.get(n) for n in names] for r in (row, other, dict(ID="z", kingdom="Animalia"))], ", ".join(f"`col:{n}` string" for n in names))
    vernacular = frame(spark, "col:taxonID,col:language,col:name\na,deu,Weiße Rose\na,,x")
    distribution = frame(spark, "col:taxonID,col:area,col:areaID,col:gazetteer,col:degreeOfEstablishment,col:establishmentMeans\na,,GER-OO,tdwg,native,\na,Côte d'Ivoire (west),,text,,native\na,FR,,text,,\na,Somewhere,,text,,")
    references = spark.createDataFrame([("r1", ([[1753, 5]],), "Title (1799)", "In: Sp. Pl. 4: 3", "10.5962/BHL.title.669")], "id string, issued struct<`date-parts`:array<array<int>>>, title string, `container-title` string, DOI string")
    gazetteer = frame(spark, "name,code\ncote d ivoire,xx\nCote dIvoire,ivo")
    got = by_id(extracts.col(usages, vernacular, distribution, references, gazetteer, CODES))
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a["name_clean"], a["hybrid"], a["year"], a["publication_short"], a["bhl_title"], a["tropicos_id"], a["extinct"]) == ("rosa alba", True, 1753, "Sp. Pl.", 669, 27, False)
    assert a["native_to"] == ["ger", "ivo"] and a["regions"] == ["fr", "ger", "ivo"] and a["vernacular"] == ["de:weiße rose"]
    assert got["b"]["year"] == 1761 and got["b"]["wfo_id"] == "wfo-0001" and got["b"]["hybrid"] is False


def test_ncbi(spark):
    nodes = frame(spark, "taxid,parent,rank\n1,1,no rank\n10,1,kingdom\n11,10,genus\n12,11,species\n20,1,kingdom", taxid=int, parent=int)
    names = spark.createDataFrame(
        [(10, "Viridiplantae", "scientific name\t|"), (11, "Rosa", "scientific name\t|"), (11, "Rosa L., 1753", "authority\t|"), (11, "Other Rosa", "authority\t|"), (11, "Rosa", "authority\t|"), (12, "Rosa alba", "scientific name\t|"), (12, "White Rose ", "common name\t|"), (12, "white rose", "genbank common name\t|"), (20, "Metazoa", "scientific name\t|")],
        "taxid long, name string, name_class string",
    )
    merged = frame(spark, "old_taxid,new_taxid\n99,12\n98,12\n97,20", old_taxid=int, new_taxid=int)
    got = by_id(extracts.ncbi(nodes, names, merged, [10]))
    assert set(got) == {10, 11, 12}
    assert got[11]["author_raw"] == "L., 1753" and got[12]["vernacular"] == ["en:white rose"] and got[12]["merged_from"] == [98, 99] and got[12]["parent_raw"] == 11


def test_inaturalist(spark):
    taxa = frame(spark, "id,parentNameUsageID,scientificName,taxonRank,kingdom,phylum,class,order,family,genus\n1,https://www.inaturalist.org/taxa/5,Rosa,genus,Plantae,,,,Rosaceae,Rosa\n2,,Felis,genus,Animalia,,,,,")
    vernacular = spark.createDataFrame([("1", "Roses, Briars and allies", "en"), ("1", "Rosen", "de-DE"), ("1", "x", "und"), ("1", "y", "English")], "id string, vernacularName string, language string")
    got = by_id(extracts.inaturalist(taxa, vernacular, CODES))
    assert set(got) == {1} and got[1]["parent_raw"] == 5 and got[1]["accepted"]
    assert got[1]["vernacular"] == ["de:rosen", "en:briars", "en:roses"]


def test_iucn(spark):
    cols = "id,scientificName,kingdom,phylum,class,order,family,genus,scientificNameAuthorship,taxonRank,taxonomicStatus,references\n"
    taxa = frame(spark, cols + "1,Rosa alba L.,PLANTAE,,,,ROSACEAE,Rosa,L.,species,accepted,https://www.iucnredlist.org/species/1/777\n1_2,Rosa alba,PLANTAE,,,,,,,,,\n3,Felis,ANIMALIA,,,,,,,,,")
    vernacular = spark.createDataFrame([("1", 'White "Rose" ( garden', "eng"), ("1", "Rose (erronously: Rosa) blanche", "fra"), ("1", "Species code: X", "eng"), ("1", "x", "en")], "id string, vernacularName string, language string")
    distribution = frame(spark, "id,threatStatus\n1,Near Threatened\n3,Extinct")
    got = by_id(extracts.iucn(taxa, vernacular, distribution, CODES))
    assert set(got) == {1}
    assert (got[1]["name_clean"], got[1]["iucn_status"], got[1]["iucn_assessment"], got[1]["family"]) == ("rosa alba", "NT", 777, "rosaceae")
    assert got[1]["vernacular"] == ["en:white rose (garden)", "fr:rose blanche"]


def test_bhl(spark):
    pages = frame(spark, "PageID,ItemID,Year,PageTypeName\n1,100,1800,Text\n2,100,,Illustration\n3,200,,Text\n4,300,,Text\n5,100,1750?,Text", PageID=int, ItemID=int)
    names = frame(spark, "PageID,NameConfirmed\n1,Rosa alba\n2,Rosa alba\n3,Rosa alba\n4,Rosa alba\n5,Poa 9 annua\n1,123", PageID=int)
    items = frame(spark, "ItemID,Year,TitleID\n100,1801,7\n200,1790,8\n300,,8", ItemID=int, TitleID=int)
    titles = frame(spark, "TitleID,LanguageCode,ShortTitle,FullTitle\n7,LAT,,The full title\n8,CHI,Short,Long", TitleID=int)
    creators = frame(spark, "TitleID,CreatorName\n7,Linné\n7,Carl", TitleID=int)
    got = {(r.name_clean, r.mention_type): r for r in extracts.bhl(pages, names, items, titles, creators).collect()}
    assert {k: (r.id_raw, r.year) for k, r in got.items()} == {
        ("rosa alba", "first_mention"): (3, 1790), ("rosa alba", "first_illustration"): (2, 1801), ("rosa alba", "first_eastern"): (3, 1790), ("poa annua", "first_mention"): (5, 1750),
    }
    assert got["poa annua", "first_mention"].title == "The full title" and got["poa annua", "first_mention"].author_raw == "Carl, Linné" and got["rosa alba", "first_eastern"].title == "Short"


def snak(value, **more):
    return {"mainsnak": {"datavalue": {"value": value}}, **more}


def test_wikidata(spark):
    claims = {
        "P225": [snak("Rosa × alba", qualifiers={"P574": [{"datavalue": {"value": {"time": "+1753-05-01T00:00:00Z"}}}], "P405": [{"datavalue": {"value": {"id": "Q1043"}}}]}, references=[{"snaks": {"P687": [{"datavalue": {"value": "555"}}]}}])],
        "P105": [snak({"id": "Q7432"})], "P171": [snak({"id": "Q34687"})], "P961": [snak("urn:lsid:ipni.org:names:1-1")], "P846": [snak("42")], "P685": [snak("3764")], "P3151": [snak("x77")],
        "P279": [snak({"id": "Q157957"}), snak({"id": "Q9323487"})], "P366": [snak({"id": "Q188840"})], "P373": [snak("Rosa alba cat")],
        "P1843": [snak({"language": "deu", "text": "Weiße Rose, Rosenbusch"}), snak({"language": "und", "text": "no"})],
    }
    rows = [
        ("Q1", json.dumps(claims), json.dumps({"en": {"language": "en", "value": "White rose"}, "la": {"language": "la", "value": "rosa × alba"}}), json.dumps({"en": [{"language": "en", "value": "Dog; var. rose"}]}),
         json.dumps({"frwiki": {"title": "Rosier blanc"}, "specieswiki": {"title": "Rosa alba"}, "enwikiquote": {"title": "no"}})),
        ("P5", "{}", "{}", "{}", "{}"), ("Q2", "{}", "{}", "{}", "{}"), ("Q3", json.dumps({"P225": [snak("Poa")]}), None, None, "not json"),
    ]
    got = by_id(extracts.wikidata(spark.createDataFrame(rows, "id string, claims string, labels string, aliases string, sitelinks string"), CODES))
    assert set(got) == {"Q1", "Q3"}
    one = got["Q1"]
    assert (one["name_clean"], one["hybrid"], one["rank_clean"], one["parent_raw"], one["year"], one["qauthor"], one["bhl_page"]) == ("rosa alba", True, "species", "Q34687", 1753, "Q1043", "555")
    assert (one["ipni_id"], one["gbif_id"], one["ncbi_id"], one["inaturalist_id"], one["wikicommons"], one["wikispecies"], one["page_count"]) == ("1-1", 42, "3764", 77, "Rosa alba cat", "Rosa alba", 2)
    assert {k for k in extracts.TRAITS if one[k]} == {"perennial", "edible", "medicinal"}
    assert one["vernacular"] == {"de": ["Rosenbusch", "Weiße Rose"], "en": ["Dog", "White rose"], "fr": ["Rosier blanc"]}
    assert got["Q3"]["rank_raw"] == "unranked" and got["Q3"]["vernacular"] is None and not got["Q3"]["edible"]


@pytest.mark.parametrize("text, want", [("in Sp. Pl. 4(2): 576", "Sp. Pl."), ("Flora 12", "Flora"), ("no volume", None), (None, None)])
def test_publication(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(extracts.publication(df.t)).first()[0] == want
