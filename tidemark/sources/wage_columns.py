"""Column mapping of the prevailing-wage releases."""

from __future__ import annotations

import csv
import io

# Each column name a release may use, and its name in the 2025 release.
WAGE_COLUMNS = """\
ORIGINAL,FINAL_2025
ACWIA_AFFILIATED_NON_PROFIT,ACWIA_AFFILIATED_NON_PROFIT
ACWIA_INST_HIGHER_EDUCATION,ACWIA_INST_HIGHER_EDUCATION
ACWIA_RESEARCH_ORG,ACWIA_RESEARCH_ORG
ACWIA_STATUS_CHANGED,ACWIA_STATUS_CHANGED
ADDITIONAL_WORKSITE_LOCATIONS,OTHER_WORKSITE_LOCATION
AGENT_ATTORNEY_ADDRESS_1,AGENT_ATTORNEY_ADDRESS_1
AGENT_ATTORNEY_ADDRESS_2,AGENT_ATTORNEY_ADDRESS_2
AGENT_ATTORNEY_CITY,AGENT_ATTORNEY_CITY
AGENT_ATTORNEY_COUNTRY,AGENT_ATTORNEY_COUNTRY
AGENT_ATTORNEY_EMAIL_ADDRESS,AGENT_ATTORNEY_EMAIL_ADDRESS
AGENT_ATTORNEY_FIRST_NAME,AGENT_ATTORNEY_FIRST_NAME
AGENT_ATTORNEY_LAST_NAME,AGENT_ATTORNEY_LAST_NAME
AGENT_ATTORNEY_MIDDLE_NAME,AGENT_ATTORNEY_MIDDLE_NAME
AGENT_ATTORNEY_PHONE,AGENT_ATTORNEY_PHONE
AGENT_ATTORNEY_PHONE_EXT,AGENT_ATTORNEY_PHONE_EXT
AGENT_ATTORNEY_POSTAL_CODE,AGENT_ATTORNEY_POSTAL_CODE
AGENT_ATTORNEY_PROVINCE,AGENT_ATTORNEY_PROVINCE
AGENT_ATTORNEY_STATE,AGENT_ATTORNEY_STATE
ALTERNATIVE_REQUIREMENTS,ALTERNATIVE_REQUIREMENTS
ALT_EDUCATION_LEVEL,ALT_EDUCATION_LEVEL
ALT_EDUCATION_MAJOR,ALT_EDUCATION_MAJOR
ALT_EXPERIENCE,ALT_EXPERIENCE
ALT_EXPERIENCE_MONTHS,ALT_EXPERIENCE_MONTHS
ALT_FOREIGN_LANGUAGE,ALT_FOREIGN_LANGUAGE
ALT_LICENSE_CERT,ALT_LICENSE_CERT
ALT_OTHER_DEGREE,ALT_OTHER_DEGREE
ALT_OTHER_REQ,ALT_OTHER_REQ
ALT_PWD_OES_WAGE_LEVEL,ALT_PWD_OES_WAGE_LEVEL
ALT_PWD_SURVEY_NAME,ALT_PWD_SURVEY_NAME
ALT_PWD_UNIT_OF_PAY,ALT_PWD_UNIT_OF_PAY
ALT_PWD_WAGE_RATE,ALT_PWD_WAGE_RATE
ALT_PWD_WAGE_SOURCE,ALT_PWD_WAGE_SOURCE
ALT_RES_FELLOWSHIP,ALT_RES_FELLOWSHIP
ALT_SPECIAL_SKILLS,ALT_SPECIAL_SKILLS
ALT_TRAINING,ALT_TRAINING
ALT_TRAINING_MONTHS,ALT_TRAINING_MONTHS
ALT_TRAINING_NAME,ALT_TRAINING_NAME
BLS_AREA,BLS_AREA
BUSINESS_NAME,EMPLOYER_LEGAL_BUSINESS_NAME
CASE_NUMBER,CASE_NUMBER
CASE_STATUS,CASE_STATUS
CBA,CBA
CENTER_DIRECTOR_REVIEW_DATE,CENTER_DIRECTOR_REVIEW_DATE
COVERED_BY_ACWIA,COVERED_BY_ACWIA
DETERMINATION_DATE,DETERMINATION_DATE
DETERMINATION_ISSUED,DETERMINATION_DATE
EIN,EMPLOYER_FEIN
EMPLOYER_ADDFRESS_1,EMPLOYER_ADDRESS_1
EMPLOYER_ADDRESS_1,EMPLOYER_ADDRESS_1
EMPLOYER_ADDRESS_2,EMPLOYER_ADDRESS_2
EMPLOYER_CITY,EMPLOYER_CITY
EMPLOYER_COUNTRY,EMPLOYER_COUNTRY
EMPLOYER_EXTENSION,EMPLOYER_EXTENSION
EMPLOYER_FEIN,EMPLOYER_FEIN
EMPLOYER_LEGAL_BUSINESS_NAME,EMPLOYER_LEGAL_BUSINESS_NAME
EMPLOYER_PHONE,EMPLOYER_PHONE
EMPLOYER_POC_ADDRESS1,EMPLOYER_POC_ADDRESS1
EMPLOYER_POC_ADDRESS2,EMPLOYER_POC_ADDRESS2
EMPLOYER_POC_CITY,EMPLOYER_POC_CITY
EMPLOYER_POC_COUNTRY,EMPLOYER_POC_COUNTRY
EMPLOYER_POC_EMAIL,EMPLOYER_POC_EMAIL
EMPLOYER_POC_FIRST_NAME,EMPLOYER_POC_FIRST_NAME
EMPLOYER_POC_JOB_TITLE,EMPLOYER_POC_JOB_TITLE
EMPLOYER_POC_LAST_NAME,EMPLOYER_POC_LAST_NAME
EMPLOYER_POC_MIDDLE_NAME,EMPLOYER_POC_MIDDLE_NAME
EMPLOYER_POC_PHONE,EMPLOYER_POC_PHONE
EMPLOYER_POC_PHONE_EXT,EMPLOYER_POC_PHONE_EXT
EMPLOYER_POC_POSTAL_CODE,EMPLOYER_POC_POSTAL_CODE
EMPLOYER_POC_PROVINCE,EMPLOYER_POC_PROVINCE
EMPLOYER_POC_STATE,EMPLOYER_POC_STATE
EMPLOYER_POSTAL_CODE,EMPLOYER_POSTAL_CODE
EMPLOYER_PROVINCE,EMPLOYER_PROVINCE
EMPLOYER_STATE,EMPLOYER_STATE
EMP_EXPERIENCE_MONTHS,ALT_EXPERIENCE_MONTHS
EMP_EXPERIENCE_REQD,REQUIRED_EXPERIENCE
EMP_EXPERIENCE_REQUIRED,REQUIRED_EXPERIENCE
EMP_SOC_CODES,EMP_SOC_CODES
EMP_SOC_TITLES,EMP_SOC_TITLES
H2B_HIGHEST_PWD,H2B_HIGHEST_PWD
JOB_TITLE,JOB_TITLE
LAWFIRM_NAME_BUSINESS_NAME,LAWFIRM_NAME_BUSINESS_NAME
MAJOR,REQUIRED_EDUCATION_MAJOR
NAME_REQD_TRAINING,REQUIRED_TRAINING
NAME_REQUIRED_TRAINING,REQUIRED_TRAINING
NUMBER_OF_MONTHS_TRAINING,REQUIRED_TRAINING_MONTHS
NUM_MONTHS_TRAINING,REQUIRED_TRAINING_MONTHS
OCCUPATION_REQUIRED,REQUIRED_OCCUPATION
OTHER_EDUCATION,REQUIRED_OTHER_DEGREE
OTHER_WORKSITE_LOCATION,OTHER_WORKSITE_LOCATION
O_NET_CODE,O_NET_CODE
O_NET_CODE_COMBO,O_NET_CODE_COMBO
O_NET_TITLE,O_NET_TITLE
O_NET_TITLE_COMBO,O_NET_TITLE_COMBO
PREVAIL_WAGE_DETERM_DATE,PREVAIL_WAGE_DETERM_DATE
PRIMARY_EDUCATION_LEVEL,REQUIRED_EDUCATION_LEVEL
PRIMARY_WORKSITE_ADDRESS_1,PRIMARY_WORKSITE_ADDRESS_1
PRIMARY_WORKSITE_ADDRESS_2,PRIMARY_WORKSITE_ADDRESS_2
PRIMARY_WORKSITE_COUNTY,PRIMARY_WORKSITE_COUNTY
PRIMARY_WORKSITE_POSTAL_CODE,PRIMARY_WORKSITE_POSTAL_CODE
PRIMARY_WORKSITE_STATE,PRIMARY_WORKSITE_STATE
PROF_SPORTS_LEAGUE,PROF_SPORTS_LEAGUE
PWD_OES_WAGE_LEVEL,PWD_OES_WAGE_LEVEL
PWD_SOC_CODE,PWD_SOC_CODE
PWD_SOC_CODE_TITLE,PWD_SOC_TITLE
PWD_SOC_TITLE,PWD_SOC_TITLE
PWD_SURVEY_NAME,PWD_SURVEY_NAME
PWD_UNIT_OF_PAY,PWD_UNIT_OF_PAY
PWD_WAGE_EXPIRATION_DATE,PWD_WAGE_EXPIRATION_DATE
PWD_WAGE_LEVEL,PWD_OES_WAGE_LEVEL
PWD_WAGE_RATE,PWD_WAGE_RATE
PWD_WAGE_SOURCE,PWD_WAGE_SOURCE
PW_JOB_TITLE,JOB_TITLE
PW_SOC_TITLE,PWD_SOC_TITLE
PW_UNIT_OF_PAY,PWD_UNIT_OF_PAY
PW_WITHDRAWAL_DATE,WITHDRAWAL_DATE
RECEIVED_DATE,RECEIVED_DATE
REDETERMINATION_DATE,REDETERMINATION_DATE
REDTERMINATION_DATE,REDETERMINATION_DATE
REQUESTED_WAGE_SOURCE,WAGE_SOURCE_REQUESTED
REQUESTOR_POC_ADDRESS1,EMPLOYER_POC_ADDRESS1
REQUESTOR_POC_ADDRESS2,EMPLOYER_POC_ADDRESS2
REQUESTOR_POC_CITY,EMPLOYER_POC_CITY
REQUESTOR_POC_COUNTRY,EMPLOYER_POC_COUNTRY
REQUESTOR_POC_EMAIL,EMPLOYER_POC_EMAIL
REQUESTOR_POC_FIRST_NAME,EMPLOYER_POC_FIRST_NAME
REQUESTOR_POC_JOB_TITLE,EMPLOYER_POC_JOB_TITLE
REQUESTOR_POC_LAST_NAME,EMPLOYER_POC_LAST_NAME
REQUESTOR_POC_MIDDLE_NAME,EMPLOYER_POC_MIDDLE_NAME
REQUESTOR_POC_PHONE,EMPLOYER_POC_PHONE
REQUESTOR_POC_PHONE_EXT,EMPLOYER_POC_PHONE_EXT
REQUESTOR_POC_POSTAL_CODE,EMPLOYER_POC_POSTAL_CODE
REQUESTOR_POC_PROVINCE,EMPLOYER_POC_PROVINCE
REQUESTOR_POC_STATE,EMPLOYER_POC_STATE
REQUIRED_EDUCATION_LEVEL,REQUIRED_EDUCATION_LEVEL
REQUIRED_EDUCATION_MAJOR,REQUIRED_EDUCATION_MAJOR
REQUIRED_EXPERIENCE,REQUIRED_EXPERIENCE
REQUIRED_EXPERIENCE_MONTHS,REQUIRED_EXPERIENCE_MONTHS
REQUIRED_OCCUPATION,REQUIRED_OCCUPATION
REQUIRED_OTHER_DEGREE,REQUIRED_OTHER_DEGREE
REQUIRED_TRAINING,REQUIRED_TRAINING
REQUIRED_TRAINING_MONTHS,REQUIRED_TRAINING_MONTHS
REQUIRED_TRAINING_NAME,REQUIRED_TRAINING_NAME
SECOND_DIPLOMA,SECOND_EDUCATION
SECOND_DIPLOMA_MAJOR,SECOND_EDUCATION_MAJOR
SECOND_EDUCATION,SECOND_EDUCATION
SECOND_EDUCATION_MAJOR,SECOND_EDUCATION_MAJOR
SPECIAL_REQUIREMENTS,SPECIAL_SKILLS_REQUIREMENTS
SPECIAL_SKILLS_REQUIREMENTS,SPECIAL_SKILLS_REQUIREMENTS
SPEC_REQ_FOREIGN_LANG,SPEC_REQ_FOREIGN_LANG
SPEC_REQ_LICENSE_CERT,SPEC_REQ_LICENSE_CERT
SPEC_REQ_OTHER,SPEC_REQ_OTHER
SPEC_REQ_RES_FELLOW,SPEC_REQ_RES_FELLOW
STATUS,CASE_STATUS
SUBMIT_DATE,RECEIVED_DATE
SUGGESTED_SOC_CODE,SUGGESTED_SOC_CODE
SUGGESTED_SOC_TITLE,SUGGESTED_SOC_TITLE
SUPERVISE_OTHER_EMP,SUPERVISE_OTHER_EMP
SUPERVISOR_JOB_TITLE,SUPERVISOR_JOB_TITLE
SURVEY_NAME,SURVEY_NAME
SURVEY_PUBLICATION_DATE,SURVEY_PUBLICATION_DATE
TRADE_NAME,TRADE_NAME_DBA
TRADE_NAME_DBA,TRADE_NAME_DBA
TRAVEL_DETAILS,TRAVEL_DETAILS
TYPE_OF_REPRESENTATION,TYPE_OF_REPRESENTATION
VISA_CLASS,VISA_CLASS
WAGE_DET_NOTES,WAGE_DET_NOTES
WAGE_SOURCE_REQUESTED,WAGE_SOURCE_REQUESTED
WITHDRAWAL_DATE,WITHDRAWAL_DATE
"""


def wage_columns() -> dict[str, str]:
    """The mapping above as original name to final name."""
    return {row["ORIGINAL"].strip(): row["FINAL_2025"].strip() for row in csv.DictReader(io.StringIO(WAGE_COLUMNS))}
