from dataclasses import replace

from morbidity.config import Config
from morbidity.operators import codelists
from morbidity.sources.readers import clean_disease_map

CFG = Config()


def test_load_codelist(make, rows):
    raw = make("Disease string, MedCodeId string, System string",
               [("Lung cancer", "1", "Cancers"), ("Low mood", "2", "Mental Health Disorders"), ("Gout x", "3", "Other"),
                ("No system", "4", None), ("No code", None, "Other")])
    assert rows(codelists.load_codelist(raw), "disease", "medcodeid", "read") == [
        ("Gout_x", 3, 9999999), ("Low_mood", 2, 365), ("Lung_cancer", 1, 1826), ("No_system", 4, None)]


def test_groups_list_a_condition_twice(make, rows):
    m = make("Disease string, list_disease_real string",
             [("Lung", "Lung cancer"), ("AF", "Atrial fibrilation"), ("Gout", "Gout"), ("Alcohol Misuse", "Alcohol problems")])
    cleaned = clean_disease_map(m, CFG)
    assert rows(cleaned, "Disease", "list_disease_real", "main_cond") == [
        ("AF", "Atrial fibrillation", 1), ("Alcohol_Misuse", "Alcohol problems", 1), ("Gout", "Gout", 0),
        ("Lung", "Lung cancer", 1)]
    assert rows(codelists.with_groups(cleaned, CFG), "list_disease_real", "disease_tomerge") == [
        ("Alcohol problems", "alcohol_problems"), ("All cancers", "lung"), ("Atrial fibrillation", "af"),
        ("Lung cancer", "lung")]


LIST = "disease string, medcodeid long, read int, list_disease_real string, descr string"


def test_description_rules(make, rows):
    df = make(LIST, [
        ("T1", 1, 9, "Diabetes excl Type 2", "Diabetes type 2"),
        ("T1", 2, 9, "Diabetes excl Type 2", "Type 1 diabetes"),
        ("T1", 3, 9, "Diabetes excl Type 2", None),
        ("T1", 4, 9, "Diabetes", "Diabetes type 2"),
        ("Alcohol_Misuse", 5, 9, "Alcohol problems", "alcoholic liver disease"),
        ("Alcohol_Misuse", 6, 9, "Alcohol problems", "liver"),
        ("Alcohol_Misuse", 7, 9, "Alcohol problems", None),
        ("Asthma", 8, 9, "Asthma", None),
    ])
    assert rows(codelists.apply_description_rules(df), "medcodeid", "disease", "list_disease_real") == [
        (1, "Type_2_Diabetes_Mellitus", "Diabetes Type 2"), (2, "T1", "Diabetes excl Type 2"), (3, None, None),
        (4, "T1", "Diabetes"), (5, "Alcohol_Misuse", "Other alcohol problems"), (6, "Alcohol_Misuse", "Alcohol problems"),
        (7, "Alcohol_Misuse", None), (8, "Asthma", "Asthma")]


def test_durations(make, rows):
    df = make(LIST, [
        ("b", 1, 9, "Alcohol problems", "x"), ("a", 1, 7, "Alcohol problems", "y"), ("c", 2, 10, "Asthma", "z"),
        ("d", 3, 11, "COPD", "z"), ("e", 4, 1826, "Lung cancer", "z"), ("f", 5, 12, "Other alcohol problems", "z"),
        ("g", 6, 13, None, "z")])
    assert rows(codelists.set_durations(df, CFG), "medcodeid", "disease", "read") == [
        (1, "a", 365), (2, "c", 365), (3, "d", 9999999), (4, "e", 1826), (5, "f", 12), (6, "g", None)]


ICD = "Disease string, Category string, ICD10code string, ICD10codeDescr string, OPCS4code string"


def test_clean_icd(make, rows):
    df = make(ICD, [
        ("End stage renal disease", "k", "N18.5", "x", None),
        ("Chronic Kidney Disease", "k", "N18", "x", "M01"),
        ("Alcohol Problems", "Diagnosis of Alcohol Problems", "K70", "fatty liver disease", None),
        ("Alcohol Problems", "Diagnosis of Alcohol Problems", "F10", None, None),
        ("Diabetes", "d", "E11.1", "x", None), ("Diabetes", "d", "E10", "x", None), ("Diabetes", "d", None, "x", None),
        ("Lupus", "c", "M32", "x", None), ("Scleroderma", "c", "L94.9", "x", None),
        ("Primary malignancy lung and trachea", "p", "C34", "x", None),
    ])
    out = rows(codelists.clean_icd(df, CFG), "ICD10code", "disease_tomerge")
    assert out == sorted([
        ("N18.5", "chronic_kidney_disease"), ("N18.5", "chronic_kidney_disease_incl_test"),
        ("N18.5", "chronic_kidney_disease_incl_test_and_proc"), ("N18", "chronic_kidney_disease_incl_test_and_proc"),
        ("K70", "alcohol_problems_other"), ("F10", None), ("E11.1", "type_2_diabetes_mellitus"),
        ("E10", "type_1_diabetes_mellitus"), (None, None), ("M32", "connective_tissue_disorder"),
        ("L94.9", "scleroderma"), ("C34", "primary_malignancy_lung")], key=repr)
    fixed = rows(codelists.clean_icd(df, replace(CFG, fix_icd=True)).where("ICD10code = 'L94.9'"), "disease_tomerge")
    assert fixed == [("connective_tissue_disorder",)]


def test_rules_are_not_repeated_when_the_key_is_joined(spark, make, tmp_path, rows):
    """A join asks for keys that aren't null; written into its filter, rules over a column grow with every rule."""
    make(ICD, [("Diabetes", "d", "E11.1", "x", None), ("Diabetes", "d", "E10", "x", None)]).write.parquet(str(tmp_path / "icd"))
    make("disease_tomerge string", [("type_1_diabetes_mellitus",)]).write.parquet(str(tmp_path / "names"))
    joined = codelists.clean_icd(spark.read.parquet(str(tmp_path / "icd")), CFG).join(spark.read.parquet(str(tmp_path / "names")), "disease_tomerge")
    assert joined._jdf.queryExecution().executedPlan().toString().count("primary_malignancy_lung_and_trachea") <= 6
    assert rows(joined, "ICD10code") == [("E10",)]


def test_expand_and_lookup(make, rows):
    df = make("ICD10code string, list_disease_real string", [("I10", "Hypertension"), ("I11.0", "Heart failure"), (None, "COPD")])
    out = rows(codelists.expand_icd(df))
    assert len(out) == 12 and ("I10.9", "Hypertension") in out and ("I11.0", "Heart failure") in out
    clean = make("ICD10code string, disease_tomerge string", [("I10", "h"), ("I11.0", "hf")])
    names = make("disease_tomerge string, list_disease_real string", [("h", "Hypertension"), ("hf", "Heart failure")])
    codes = make("list_disease_real string, read int", [("Hypertension", 9999999), ("Hypertension", 9999999), ("Pain", 365)])
    looked = rows(codelists.icd_lookup(clean, names, codes))
    assert len(looked) == 12 and (None, "Pain", 365) in looked
    assert all(r[1] != "Heart failure" for r in looked)


def test_prodcodes(make, rows):
    lists = make("cond string, gemscriptcode string", [("CON150", "g1"), ("PNC166", "g2"), ("XYZ999", "g1")])
    gem = make("gemscript_drug_code string, dmd_code long", [("g1", 10), ("g1", 11), ("g2", 20)])
    products = make("dmdid long, ProdCodeId long", [(10, 100), (11, 100), (20, 200), (20, 201)])
    assert rows(codelists.build_prodcodes(lists, gem, products, CFG)) == [
        ("CON150", 10, 100), ("CON150", 11, 100), ("PNC166", 20, 200), ("PNC166", 20, 201)]
