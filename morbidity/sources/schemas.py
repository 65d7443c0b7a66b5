"""Schema of every input table, given explicitly on read."""

PATIENT = (
    "patid long, pracid int, yob int, gender int, regstartdate date, cprd_ddate date, regenddate date"
)
PRACTICE = "pracid int, region int, lcd date"
HOSPITAL_LINK = "patid long, gen_hesid long"
DEATH_REGISTER = "patid long, dod date, match_rank int"
DEPRIVATION = "patid long, imd2015_decile int"
OBSERVATION = (
    "patid long, obsid long, parentobsid long, medcodeid long, obsdate date, enterdate date, "
    "obstypeid int, value double"
)
DRUG_ISSUE = "patid long, prodcodeid long, issuedate date"
INPATIENT_DIAGNOSIS = "patid long, epistart string, epiend string, icd string"
INPATIENT_PROCEDURE = "patid long, evdate date, epistart date"
INPATIENT_EPISODE = "patid long, admidate date, ethnos string"
EMERGENCY_ATTENDANCE = "patid long, arrivaldate date, ethnos string"
OUTPATIENT_VISIT = "patid long, apptdate string, ethnos string"
OUTPATIENT_CLINICAL = "patid long, attendkey long, diag_01 string, diag_02 string, diag_03 string"
OUTPATIENT_APPOINTMENT = "patid long, attendkey long, apptdate string"
MEDCODE_FILE = "Disease string, MedCodeId long, Descr string, System string"
MEDCODE_LIST = "disease string, medcodeid long, descr string, system string"
DISEASE_MAP = "Disease string, list_disease_real string"
ICD_FILE = "Disease string, Category string, ICD10code string, ICD10codeDescr string, OPCS4code string"
GP_ETHNICITY_LOOKUP = "medcodeid long, Term string, Group1 string, Group2 string, Group3 string"
HOSPITAL_ETHNICITY_LOOKUP = "HES_ethnic_group string, HES_category string"
DRUG_LIST = "gemscriptcode string"
GEMSCRIPT_MAP = "gemscript_drug_code string, dmd_code long"
PRODUCT_DICTIONARY = "dmdid long, ProdCodeId long"
