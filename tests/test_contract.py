"""The occupations and subtypes that given titles must get."""

import pytest

from adloom.functions import text
from adloom.operators import rules
from pyspark.sql import functions as F

# Titles and the occupation that each must get.
ROOTS = [
    ("Administrátor online reklamy", "Administrator"), ("Senior Payroll Administrator – Prague | Pharma | Hybrid", "Administrator"), ("Operátor/ka call centra - neomezené bonusy!", "Customer Service Representative"),
    ("Technical Support Representative", "Support Specialist"), ("Sales Representatives/Consultant - Energy Management System", "Sales Representative"), ("Specialista/ka klientské podpory - back office", "Support Specialist"),
    ("Master Data Co-Ordinator", "Coordinator"), ("Purchasing Coordinator (elektro) - Praha-západ", "Coordinator"), ("⚡️Obchodník po telefonu s duší poradce | neomezené provize | Praha", "Sales Representative"),
    ("Specialista zákaznického centra", "Customer Service Representative"), ("IT Core Process Specialist - Cloud & Architecture (f/m/d)", "Specialist"), ("Senior Java Developer - AI-Driven Engineer (m/f)", "Developer"),
    ("Team leader/Programátor — DEK a.s.", "Manager"), ("Supply Chain Import Planner (m/ž)", "Planner"), ("Finance & Accounting Specialist", "Specialist"), ("Security & Emergency Response Planning Coordinator", "Coordinator"),
    ("Business Developer - vývoj elektronických systémů", "Sales Representative"), ("Python programátor/ka pro DevOps tým", "Developer"), ("Podpora controllingu - 20 h týdně", "Assistant"), ("QA Tester s vizí: víc než jen klikání!", "Tester"),
    ("Test analytik / Tester (m/ž) - O2 CRM Services", "Tester"), ("Asistent/ka v developerské společnosti s přesahem do marketingu", "Assistant"), ("HRIS & Process Excellence Partner", "Specialist"), ("HLEDÁME LEKTORY Z BANKOVNÍ PRAXE", "Teacher/Trainer"),
    ("Sales Entry Point – CZ & SK (Sales Rep / Sales Operations Assistant)", "Sales Representative"), ("Network Application Developer and Tester", "Developer"), ("SW Engineer/Vývojář C++", "Engineer"), ("Senior Cloud Engineer/ Architect", "Architect"),
    ("AI Solution Architect / Analyst | Enterprise projekty", "Architect"), ("KONZULTANT – SYSTÉMOVÝ A PROCESNÍ ANALYTIK", "Analyst"), ("Developer Experience Engineer (DevEx)", "Engineer"), ("Aplikační specialist(k)a - správce aplikačního SW", "Specialist"),
    ("Investigativní specialista - interní bezpečnost", "Specialist"), ("Specialista vývoje - test management řídící jednotky", "Specialist"), ("IT Business Analyst - SW Engineering projekty", "Analyst"), ("Lead Generation Specialist/ka - B2B - Finance", "Specialist"),
    ("Application Support Engineer", "Engineer"), ("Customer Support Engineer", "Engineer"), ("Projektmanager standardizace logistických procesů (m/ž)", "Manager"), ("Compliance Trainee", "Intern/Trainee"),
    ("Asistent/ka plánování výroby - Junior Supply Chain Planner", "Planner"), ("Fashion Developer/ka pro vlastní kolekce spodního prádla a plavek", "Designer"), ("Finanční a personální administrativa", "Administrator"),
    ("Data Engineer Intern", "Engineer"), ("Procurement Specialist Trainee - part time", "Specialist"), ("Trainee - Finance (M/Ž)", "Intern/Trainee"), ("Trainee Marketing Specialist", "Specialist"), ("Senior Demand & Supply Planner / S&OP Lead", "Manager"),
    ("Trainee do finančního oddělení (CFO office)", "Intern/Trainee"), ("Executive Assistant to CEO", "Assistant"), ("Chief Data Officer", "Manager"), ("Finanční kontrolor/ka", "Controller"), ("IT vyučující - VŠ předměty v AJ", "Teacher/Trainer"),
    ("Odborný pracovník oddělení klimatologie", "Specialist"), ("B2B Marketing Specialist (hands-on role s ambicí vyrůst v CMO)", "Specialist"),
]
# Titles with their occupation and the subtype that each must get.
SUBTYPES = [
    ("Senior Product Owner", "Manager", "Product Manager/Product Owner"), ("Projektový manažer implementace", "Manager", "Project Manager"), ("Senior Key Account Manager", "Manager", "Sales/Account Manager"),
    ("Marketing & Brand Manager", "Manager", "Marketing/Brand Manager"), ("Head of Data Engineering & AI", "Manager", "Data/AI Manager"), ("Service Delivery Manager", "Manager", "Operations/Service Delivery Manager"),
    ("Service Delivery Manager / SW Development Lead, Top Projekty", "Manager", "IT/Engineering Manager"), ("Test Lead / Senior QA Tester", "Manager", "Production/Quality Manager"), ("Specialista marketingové komunikace", "Specialist", "Marketing/Communications Specialist"),
    ("Master Data Specialist", "Specialist", "Data Governance/Quality Specialist"), ("AML Specialista", "Specialist", "Compliance/AML Specialist"), ("IT Specialista bezpečnosti informací", "Specialist", "Cybersecurity Specialist"), ("Data Engineer", "Engineer", "Data Engineer"),
    ("Senior Machine Learning Engineer", "Engineer", "AI/ML Engineer"), ("Principal DevOps Engineer", "Engineer", "DevOps/SRE Engineer"), ("System Test Engineer", "Engineer", "QA/Test Engineer"), ("L1 Network Support Engineer", "Engineer", "Network/Infrastructure Engineer"),
    ("Business Analyst", "Analyst", "Business/Process Analyst"), ("IT Business Analyst", "Analyst", "IT/Systems Analyst"), ("Financial Data Analyst", "Analyst", "Data/BI Analyst"), ("Security Analyst", "Analyst", "Security/Fraud Analyst"),
    ("Senior Kotlin Developer", "Developer", "General Software Developer"), ("Oracle PL/SQL Developer", "Developer", "Data/Database Developer"), ("Junior PHP Full-Stack Developer", "Developer", "Full-Stack Developer"), ("Senior Backend Developer (PHP)", "Developer", "Backend Developer"),
    ("SAP konzultant", "Consultant", "SAP/ERP Consultant"), ("Analytics Implementation Consultant", "Consultant", "Data/Analytics Consultant"), ("SENIOR WINDOWS ADMINISTRÁTOR", "Administrator", "Systems/Server Administrator"), ("Data Center Administrator", "Administrator", "Network/Infrastructure Administrator"),
    ("Business Development Representative", "Sales Representative", "Business Development Representative"), ("Enterprise Architect", "Architect", "Enterprise Architect"), ("AI Architect", "Architect", "AI Architect"), ("IT Hardware & Support Specialist", "Support Specialist", "Infrastructure/Network Support"),
    ("Financial Controller", "Controller", "Financial Controller"), ("Customer Care Specialist", "Customer Service Representative", "Customer Care Representative"), ("QA TECHNIK - AUTOMOTIVE", "Technician", "Quality/Test Technician"), ("Payroll Accountant", "Accountant", "Payroll Accountant"),
    ("Sales Operations Coordinator", "Coordinator", "Sales/Marketing Coordinator"), ("OFFICE ASSISTANT", "Assistant", "Office/Reception Assistant"), ("Automation Tester", "Tester", "Automation Tester"), ("Service Product Designer", "Designer", "UX/UI/Product Designer"),
    ("Supply Chain Import Planner", "Planner", "Demand/Supply Planner"), ("Administrativní podpora / Back Office", "Assistant", "Administrative/Back-Office Assistant"), ("Data Security Consultant", "Consultant", "Security Consultant"), ("Software tester senior - FinTech", "Tester", "General Software Tester"),
    ("Trade Marketing & Customer Strategy Lead CZSK", "Manager", "Marketing/Brand Manager"), ("Freight Audit Senior Specialist", "Specialist", "Logistics/Supply Chain Specialist"), ("Manažer realizace stavebních projektů", "Manager", "Project Manager"),
    ("Projektmanager standardizace logistických procesů", "Manager", "Project Manager"), ("Senior/Lead Backend Engineer – AI / HR Tech", "Manager", "IT/Engineering Manager"), ("Business development manažer – senior pro segment komerční development", "Manager", "Sales/Account Manager"),
    ("Specialista na komunikaci se zákazníky", "Specialist", "Customer Service Specialist"), ("DevOps specialista pro datová uložiště", "Specialist", "IT/Systems Specialist"), ("Sales Representative", "Sales Representative", "General Sales Representative"),
    ("CRM a Sales Operations Specialist", "Specialist", "Sales/Commercial Specialist"), ("R&D inženýr-bezpečnost vozu", "Engineer", "Automotive/Safety Engineer"), ("Konzultant AI/Data transformace a change management", "Consultant", "AI/Transformation Consultant"),
    ("Senior M&A Analyst/Advisor", "Analyst", "Finance/Investment Analyst"), ("Group Automation & Control Systems Lead", "Manager", "IT/Engineering Manager"), ("Patent Specialist / Technický analytik inovací", "Analyst", "Technical/R&D Analyst"),
    ("IT SPECIALISTA/ SPRÁVCE IT INFRASTRUKTURY", "Administrator", "Network/Infrastructure Administrator"), ("Specialista implementace úvěrových strategií", "Specialist", "Finance/Banking Specialist"), ("Metodik - specialista uživatelského rozvoje aplikací", "Specialist", "IT/Systems Specialist"),
    ("Odhadce/odhadkyně nemovitého majetku", "Specialist", "Real Estate/Valuation Specialist"), ("Specialista ProjectWise", "Specialist", "IT/Systems Specialist"), ("Testing Engineer", "Engineer", "QA/Test Engineer"), ("HR Support - BRIGÁDA", "Support Specialist", "HR/People Support"),
    ("Research Area (R&D) Lead", "Manager", "R&D/Innovation Manager"), ("DPH daňový konzultant/poradce", "Consultant", "Finance/Transactions Consultant"), ("SPECIALISTA FINANČNÍCH DAT", "Specialist", "Data/Analytics Specialist"), ("Provozní koordinátor stravování", "Coordinator", "Operations/Service Coordinator"),
    ("3D Experience PLM Solution Specialist", "Specialist", "IT/Systems Specialist"), ("Specialista CMDB", "Specialist", "IT/Systems Specialist"), ("BIM manažer", "Manager", "Construction/BIM Manager"), ("Analytik personální bezpečnosti", "Analyst", "Security/Fraud Analyst"),
    ("Finanční referent", "Administrator", "Finance Administrator"), ("Referent oddělení finančního reportingu", "Administrator", "Finance Administrator"), ("Firemní bankéř", "Specialist", "Finance/Banking Specialist"), ("Specialista krizové připravenosti", "Specialist", "Risk/Business Continuity Specialist"),
    ("Team Lead for Actors (Node.js/TypeScript)", "Manager", "IT/Engineering Manager"), ("SENIOR BUSINESS DISCOVERY DESIGNER", "Designer", "UX/UI/Product Designer"), ("Senior specialista odměňování", "Specialist", "HR/People Specialist"), ("ONLINE MARKETINKOVÝ SPECIALISTA", "Specialist", "Marketing/Communications Specialist"),
    ("C#/.NET Tech Lead", "Manager", "IT/Engineering Manager"), ("Senior Finanční/Účetní Specialista", "Accountant", "Financial Accountant"), ("Fieldwork Coordination Allocator", "Coordinator", "Operations/Service Coordinator"), ("Backend Tech Lead", "Manager", "IT/Engineering Manager"),
    ("Middle Office Analyst", "Analyst", "Finance/Investment Analyst"), ("SENIOR INTERNÍ AUDITOR", "Auditor", "Internal Auditor"), ("Vedoucí ekonomického oddělení", "Manager", "Finance/Risk Manager"), ("Koordinátor marketingu centra", "Coordinator", "Sales/Marketing Coordinator"),
    ("Compliance Trainee", "Intern/Trainee", "Compliance/Risk Internship"), ("Asistent plánování výroby - Junior Supply Chain Planner", "Planner", "Demand/Supply Planner"), ("Fashion Developer pro vlastní kolekce", "Designer", "Fashion/Product Designer"),
    ("Finanční a personální administrativa", "Administrator", "HR/Finance Administrator"),
]
SECOND = [
    ("Administrativní podpora / Back Office", "Assistant", ""), ("Senior/Lead Backend Engineer – AI / HR Tech", "Manager", ""),
    ("Service Delivery Manager / SW Development Lead, Top Projekty", "Manager", "Operations/Service Delivery Manager"), ("Sales Manager / Key Account Manager / Head of Marketing", "Manager", "Sales/Account Manager"),
]


@pytest.fixture(scope="module")
def roots(spark):
    df = spark.createDataFrame(ROOTS, "title string, want string")
    return {r["title"]: r["root"] for r in rules.classify(df, "title", rules.ROOTS, rules.OVERRIDES).collect()}


@pytest.fixture(scope="module")
def subtypes(spark):
    df = spark.createDataFrame(SUBTYPES, "title string, root string, want string")
    return {(r["title"], r["root"]): r["got"] for r in df.select("title", "root", rules.subtype(text.normalise(F.col("title")), F.col("root")).alias("got")).collect()}


@pytest.mark.parametrize("title,want", ROOTS)
def test_root(roots, title, want):
    assert roots[title] == want


@pytest.mark.parametrize("title,root,want", SUBTYPES)
def test_subtype(subtypes, title, root, want):
    assert subtypes[title, root] == want


def test_second_subtype(spark):
    df = spark.createDataFrame(SECOND, "title string, root string, want string")
    got = {r["title"]: r["got"] for r in df.select("title", rules.secondary(F.col("title"), F.col("root")).alias("got")).collect()}
    assert got == {t: w for t, _, w in SECOND}


def test_taxonomy_gates():
    assert not rules.taxonomy_faults()
    assert rules.taxonomy_faults(roots=[rules.Rule("Nobody", "x", 3, "("), rules.Rule("Analyst", "x", 99, "a"), rules.Rule("Analyst", "x", 99, "a")], taxonomy=["Analyst"])
