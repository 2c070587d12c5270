"""Curated names: catalog name -> name in the ranking list."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# --- fixed values: name aliases -------------------------------------------

RANKING_ALIASES = {
    # Australia and New Zealand
    "Australian National University": "The Australian National University",
    "University of Melbourne": "The University of Melbourne",
    "University of New South Wales": "The University of New South Wales (UNSW Sydney)",
    "University of Queensland": "The University of Queensland",
    "University of Sydney": "The University of Sydney",
    "University of Western Australia": "The University of Western Australia",
    "University of Adelaide": "The University of Adelaide",
    "Flinders University of South Australia": "Flinders University",
    "James Cook University of North Queensland": "James Cook University",
    "University of Western Sydney": "Western Sydney University",
    "University of Newcastle": "The University of Newcastle, Australia (UON)",
    "University of Auckland": "The University of Auckland",
    "University of Canterbury": "University of Canterbury | Te Whare Wānanga o Waitaha",
    # United Kingdom and Ireland
    "University of Edinburgh": "The University of Edinburgh",
    "University of Exeter": "The University of Exeter",
    "University of Manchester": "The University of Manchester",
    "University of Warwick": "The University of Warwick",
    "University of Durham": "Durham University",
    "University of Lancaster": "Lancaster University",
    "King's College London, University of London": "King's College London",
    "London School of Economics and Political Science, University of London": "The London School of Economics and Political Science (LSE)",
    "University College London, University of London": "UCL",
    "Queen Mary, University of London": "Queen Mary University of London",
    "The Queen's University Belfast": "Queen's University Belfast",
    "The Manchester Metropolitan University": "Manchester Metropolitan University (MMU)",
    "The Robert Gordon University": "Robert Gordon University",
    "Northumbria University": "Northumbria University at Newcastle",
    "De Montfort University Leicester": "De Montfort University",
    "University of Kent at Canterbury": "University of Kent",
    "University of the West of England, Bristol": "University of the West of England",
    "South Bank University": "London South Bank University",
    "Middlesex University - London": "Middlesex University",
    "University of Essex": "Essex, University of",
    "Birkbeck College, University of London": "Birkbeck, University of London",
    "Goldsmiths College, University of London": "Goldsmiths, University of London",
    "University of Dublin, Trinity College": "Trinity College Dublin, The University of Dublin",
    "Kingston University": "Kingston University, London",
    # Switzerland and Germany
    "ETH Zurich": "ETH Zurich - Swiss Federal Institute of Technology",
    "EPFL - EPF Lausanne": "EPFL",
    "Humboldt Universität Berlin": "Humboldt-Universität zu Berlin",
    "Bayerische Julius-Maximilians-Universität Würzburg": "Julius-Maximilians-Universität Würzburg",
    "Universität Kaiserslautern": "Technische Universität Kaiserslautern",
    "Friedrich-Schiller Universität Jena": "Universität Jena",
    # France
    "Université Claude Bernard (Lyon I)": "Université Claude Bernard Lyon 1",
    "Université Jean Moulin (Lyon III)": "Université Jean Moulin Lyon 3",
    "Université Paul Sabatier (Toulouse III)": "Université Paul Sabatier Toulouse III",
    "Université Rennes I": "Université de Rennes 1 (University of Rennes)",
    "Université de Toulouse-le-Mirail (Toulouse II)": "Université de Toulouse II-Le Mirail",
    "Université de Toulouse-le-Mirail (Toulouse III)": "Université Paul Sabatier Toulouse III",
    "Université de Toulouse": "Université Paul Sabatier Toulouse III",
    "Institut National des Sciences Appliquées de Rennes": "Institut National des Sciences Appliquées de Lyon (INSA)",
    "Institut National des Sciences Appliquées de Rouen": "Institut National des Sciences Appliquées de Lyon (INSA)",
    "Institut National des Sciences Appliquées de Toulouse": "Institut National des Sciences Appliquées de Lyon (INSA)",
    # Middle East, Italy, Georgia
    "American University in Cairo": "The American University in Cairo",
    "Hebrew University of Jerusalem": "The Hebrew University of Jerusalem",
    "University of Bologna": "Alma Mater Studiorum - University of Bologna",
    "University of Milan - Bicocca": "University of Milano-Bicocca",
    "University of Venice": "Ca' Foscari University of Venice",
    "University of Verona": "Verona University",
    "University of Catania": "Catania University",
    "University of Modena": "University of Modena and Reggio Emilia",
    "Free University of Bozen": "Free University of Bozen-Bolzano",
    "Tbilisi State University": "Ivane Javakhishvili Tbilisi State University",
    "Hashemite University": "The Hashemite University",
    "Jordan University of Science and Technology": "Jordan University of Science & Technology",
    # Northern and eastern Europe, Spain
    "University of Tromsø": "University of Tromsø The Arctic University of Norway",
    "University of Southern Denmark - SDU": "University of Southern Denmark (SDU)",
    "IT University of Copenhagen": "University of Copenhagen",
    "Comenius University in Bratislava": "Comenius University Bratislava",
    "Technical University in Kosice": "Technical University of Kosice",
    "Babes-Bolyai University of Cluj-Napoca": "Babes-Bolyai University",
    "West University of Timisoara": "Universitatea de Vest din Timisoara / West University of Timisoara",
    "Universidad de Alcalá de Henares": "Universidad de Alcalá",
    "Universitat Rovira I Virgili Tarragona": "Universitat Rovira i Virgili",
    "La Salle - Universitat Ramon Llull": "Universitat Ramon Llull",
    # Asia
    "Nanyang Technological University": "Nanyang Technological University, Singapore (NTU)",
    "Lingnan University": "Lingnan University, Hong Kong",
    "University of Tokyo": "The University of Tokyo",
    "Tsukuba University": "University of Tsukuba",
    "Tampere University of Technology": "Tampere University",
    "University of Tampere": "Tampere University",
    "Universiti Teknologi Mara": "Universiti Teknologi MARA - UiTM",
    "Taylor's University College": "Taylor's University",
    "Asia Pacific University of Technology & Innovation (APU)": "Asia Pacific University of Technology and Innovation (APU)",
    "Sunway University College": "Sunway University",
    "Monash University, Malaysia Campus": "Monash University",
    "University of Nottingham, Malaysia Campus": "University of Nottingham",
    "Newcastle University, Medicine Malaysia": "Newcastle University",
    "Swinburne University of Technology, Sarawak Campus": "Swinburne University of Technology",
    "Curtin University of Technology, Sarawak Campus": "Curtin University",
    "Universiti Tun Hussein Onn Malaysia": "Universiti Tun Hussein Onn University of Malaysia (UTHM)",
    # Canada
    "Queen's University": "Queen's University at Kingston",
    "University of Toronto, Scarborough": "University of Toronto",
    "University of Toronto, Mississauga": "University of Toronto",
    "Victoria University Toronto, University of Toronto": "University of Toronto",
    "University of New Brunswick, Saint John": "University of New Brunswick",
    "École Polytechnique de Montréal, Université de Montréal": "Université de Montréal",
    "Concordia University College of Alberta": "Concordia University",
    "École nationale d'administration publique, Université du Québec": "Université du Québec",
    "École de technologie supérieure, Université du Québec": "Université du Québec",
    "Institut Armand-Frappier, Université du Québec": "Université du Québec",
    "Institut National de la Recherche Scientifique, Université du Québec": "Université du Québec",
    "Télé-université, Université du Québec": "Université du Québec",
    "Université du Québec à Chicoutimi": "Université du Québec",
    "Université du Québec à Montréal": "Université du Québec",
    "Université du Québec à Rimouski": "Université du Québec",
    "Université du Québec en Abitibi-Témiscamingue": "Université du Québec",
    "Université du Québec en Outaouais": "Université du Québec",
    "Université du Québec à Trois-Rivières": "Université du Québec",
    # Netherlands, India, United Arab Emirates
    "Wageningen University": "Wageningen University & Research",
    "Jamia Millia Islamia University": "Jamia Millia Islamia",
    "Jamia Hamdard University": "Jamia Hamdard",
    "Symbiosis International University": "Symbiosis International (Deemed University)",
    "SRM Institute Of Science & Technology": "SRM INSTITUTE OF SCIENCE AND TECHNOLOGY",
    "Thapar Institute of Engineering and Technology": "Thapar Institute of Engineering & Technology",
    "Khalifa University": "Khalifa University of Science and Technology",
    "Khalifa University of Science, Technology and Research": "Khalifa University of Science and Technology",
    "New York University, Abu Dhabi": "New York University (NYU)",
    "University of Wollongong - Dubai Campus": "University of Wollongong",
    "Paris-Sorbonne University Abu Dhabi": "Sorbonne University",
    # Poland and Ukraine
    "Jagiellonian University Cracow": "Jagiellonian University",
    "Nicolaus Copernicus University of Torun": "Nicolaus Copernicus University",
    "University of Silesia": "University of Silesia in Katowice",
    "Agricultural University of Warsaw": "Warsaw University of Life Sciences – SGGW (WULS-SGGW)",
    "Technical University of Gdansk": "Gdańsk University of Technology",
    "Technical University of Wroclaw": "Wroclaw University of Science and Technology (WRUST)",
    "Technical University of Lodz": "Lodz University of Technology",
    "Agricultural University of Wroclaw": "University of Wroclaw",
    "National University of Kiev-Mohyla Academy": "National University of Kyiv-Mohyla Academy (NaUKMA)",
    "Lviv National University Ivan Franko": "Ivan Franko National University of Lviv",
}


def alias_table(spark: SparkSession) -> DataFrame:
    """The curated aliases as (db_name, target)."""
    # Arrow data becomes a relation of known size, so that a join with it needs no shuffle.
    return spark.createDataFrame(pa.table({"db_name": list(RANKING_ALIASES), "target": list(RANKING_ALIASES.values())}))
