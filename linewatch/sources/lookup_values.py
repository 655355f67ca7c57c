"""Bundled lookup tables, stated as CSV text.

Fixed values: the five lookup tables below (codes, names, coordinates,
distances, holiday dates, operator cards) must hold exactly these entries for
the models to give the expected results.
"""

STATION_CORRIDOR_MAPPING = """\
station_code,station_name,corridor_id,corridor_name,lat,lon
ASD,Amsterdam Centraal,1,Amsterdam-Rotterdam,52.3791,4.9003
RTD,Rotterdam Centraal,1,Amsterdam-Rotterdam,51.9244,4.4690
SDM,Schiedam Centrum,1,Amsterdam-Rotterdam,51.9217,4.4089
DT,Delft,1,Amsterdam-Rotterdam,52.0067,4.3567
LEDN,Leiden Centraal,1,Amsterdam-Rotterdam,52.1663,4.4817
ASD,Amsterdam Centraal,2,Amsterdam-Utrecht,52.3791,4.9003
UT,Utrecht Centraal,2,Amsterdam-Utrecht,52.0893,5.1101
ASA,Amsterdam Amstel,2,Amsterdam-Utrecht,52.3464,4.9178
BRN,Breukelen,2,Amsterdam-Utrecht,52.1717,5.0025
GVC,Den Haag Centraal,3,Den Haag-Rotterdam,52.0808,4.3248
RTD,Rotterdam Centraal,3,Den Haag-Rotterdam,51.9244,4.4690
UT,Utrecht Centraal,4,Utrecht-Eindhoven,52.0893,5.1101
EHV,Eindhoven Centraal,4,Utrecht-Eindhoven,51.4433,5.4817
HTN,s-Hertogenbosch,4,Utrecht-Eindhoven,51.6908,5.2936
UT,Utrecht Centraal,5,Utrecht-Arnhem,52.0893,5.1101
AH,Arnhem Centraal,5,Utrecht-Arnhem,51.9847,5.8987
DB,Driebergen-Zeist,5,Utrecht-Arnhem,52.0547,5.2811
ED,Ede-Wageningen,5,Utrecht-Arnhem,52.0428,5.6500
"""

STATION_NDW_MAPPING = """\
station_code,station_name,ndw_location_id,road_name,ndw_lat,ndw_lon,distance_km
ASD,Amsterdam Centraal,ABM01_S103_PC1013_LitoeS103,S103_tussen_H Houthavens TF1031_en_A10 West HRL S103,52.390022,4.8848796,1.6
ASD,Amsterdam Centraal,GAD03_MOA_Route098,A10_AdmiraalDeRuiterweg_JanVanGalenstraat,52.37469,4.858493,2.88
ASD,Amsterdam Centraal,ABM01_S116_S116ZN_RetoeS116,S116_tussen_S116 Stad uit_en_A10 Noord HRR toe 16,52.399952,4.93006,3.07
RTD,Rotterdam Centraal,RWS09_route_26_via_A20,route 26 via A20,51.93796,4.4611745,1.6
RTD,Rotterdam Centraal,RWS09_route_25_via_A20_tot_Bergweg,route 25 via A20 tot Bergweg,51.93796,4.4611745,1.6
RTD,Rotterdam Centraal,GRT04_MORO_6247,Gordelweg kr A20 afrit 15 Crooswijk - Gordelweg kr Schieweg,51.939342,4.470482,1.66
SDM,Schiedam Centrum,RWS04_ZWN_GD_A20_R_24.7_A20_R_25.9_H,RWS04_ZWN_GD_A20_R_24.7_A20_R_25.9_H,51.925728,4.404311,0.55
SDM,Schiedam Centrum,RWS04_ZWN_GD_A20_L_28.350_A20_L_27.250,RWS04_ZWN_GD_A20_L_28.350_A20_L_27.250,51.922955,4.417473,0.6
SDM,Schiedam Centrum,GRT04_MORO_6214,Matlingeweg kr Linschotenstraat - A20 toerit 12 kr A20R,51.923615,4.4186716,0.7
DT,Delft,RDH06_4.2N,Beatrixlaan (Westlandseweg Delft-A4 Rijswijk),52.007298,4.3441215,0.86
DT,Delft,RDH06_17.6N,Vrijebanselaan Delft (Westvest-A13 Delft Noord),52.01541,4.3506794,1.05
DT,Delft,RDH06_17.1W,R. de Graafweg-Zuidhoornseweg (Beatrixlaan Delft-A4 Den Hoorn),51.999916,4.3438244,1.16
LEDN,Leiden Centraal,RWS04_ZWN_dBD95_r1_A44_DH_Centrum,dBD95 tot Den Haag-Centrum via A44,52.155,4.471926,1.42
LEDN,Leiden Centraal,PZH04_SYNCH_1433,A44d van N206 tot hmp 173.0,52.17055,4.4546723,1.9
LEDN,Leiden Centraal,RWS08_44_HRL_018.0_1,A44_HRL_van_18000_tot_17500,52.168983,4.4540043,1.91
UT,Utrecht Centraal,RWS04_MN_GD_A2_M_57.8_A2_M_61.7_P,RWS04_MN_GD_A2_M_57.8_A2_M_61.7_P,52.08368,5.075387,2.45
UT,Utrecht Centraal,ABM01_A12_PC3522_LiGalecopper,A12_tussen_H Utrecht 3522_en_A12 PRL Galecopper,52.06723,5.1132355,2.46
UT,Utrecht Centraal,RWS09_401,A28_Waterlinie_A12PRB,52.088566,5.1477194,2.57
ASA,Amsterdam Amstel,GAD03_307-A10,borchlandweg-A10,52.33278,4.923525,1.56
ASA,Amsterdam Amstel,ABM01_ASL_010HRR11_AF,A10 HRR Afrit S111,52.333984,4.9297824,1.6
ASA,Amsterdam Amstel,ABM01_ASL_010HRR11_OP,A10 HRR Oprit S111,52.331944,4.927005,1.72
BRN,Breukelen,PUT03_PUT_N401.15_Re,PUT_N401.15_Re van westelijke toe-/afrit A2 naar oostelijke toe-/afrit A2,52.171997,4.988087,0.98
BRN,Breukelen,PUT03_PUT_N401.15_Li,PUT_N401.15_Li van oostelijke toe-/afrit A2 naar westelijke toe-/afrit A2,52.172062,4.98791,1.0
BRN,Breukelen,RWS09_A2_Maarssen_Breukelen,A2 Maarssen Breukelen,52.171783,4.9874606,1.03
GVC,Den Haag Centraal,GDH01_DH_01204,A12 afrit 2 van A12 tot Juliana van Stolberglaan,52.07928,4.333794,0.64
GVC,Den Haag Centraal,RWS09_RWS012001_S2_A12Li7.3-N44-N14Re13.0,RWS012001 S2 A12Li7.3-N44-N14Re13.0,52.08665,4.322464,0.67
GVC,Den Haag Centraal,GDH01_DH_01202,A12 Utrechtsebaan van afrit 2 tot S101 Benoordenhoutseweg,52.08665,4.322464,0.67
EHV,Eindhoven Centraal,GEH01_EIN_Veldmaarschalk_Montgomerylaan_N11,Veldmaarschalk Montgomerylaan_Vincent van den Heuvellaan_Gildelaan,51.447594,5.476922,0.58
EHV,Eindhoven Centraal,GEH01_EIN_John_F_Kennedylaan_N11,John F Kennedylaan_Vincent van den Heuvellaan_RING,51.451,5.48385,0.87
EHV,Eindhoven Centraal,GEH01_EIN_Veldmaarschalk_Montgomerylaan_N14,Veldmaarschalk Montgomerylaan_Rachelsmolen_Looierstraat,51.451073,5.477614,0.91
HTN,s-Hertogenbosch,PNB05_RVM_VUG_Loonsebaan_N11,Loonsebaan_Pepereind_Taalstraat_N11,51.67194,5.292187,2.1
HTN,s-Hertogenbosch,PNB05_VUG_Deutersestraat_N14,Deutersestraat_Pepereind_Vlijmenseweg_N14,51.684563,5.2635617,2.18
HTN,s-Hertogenbosch,RWS10_A27HH_A65L_1,A65 Links Vught - De Baars,51.669907,5.316416,2.81
AH,Arnhem Centraal,PGL03_ARN_R_Apeldoornseweg_1_Ri1,Arnhem route 11 A12 - Willemsplein,51.989456,5.907841,0.82
AH,Arnhem Centraal,PGL03_ARN_R_IJssellaan_1_Ri1,Arnhem route 7 A12 - Airborneplein,51.97835,5.9180217,1.5
AH,Arnhem Centraal,RWS09_RWS100978_S4groene_route,RWS100978_s4 groene route- A28 Links knp Rijnsweerd verbindingsboog u_groene route,52.018265,5.908367,3.79
DB,Driebergen-Zeist,RWS09_352447,A12luve driebergen-veenendaal N225N416,52.050396,5.2870517,0.63
DB,Driebergen-Zeist,RWS01_MONIBAS_0121hrl0733ra1,0121hrl0733ra1,52.06523,5.29303,1.43
DB,Driebergen-Zeist,PUT03_PUT_N229.05_Re,PUT_N229.05_Re van zuidelijke toe-/afrit A12 naar Singel,52.054047,5.2256937,3.79
ED,Ede-Wageningen,PGL03_FV_B2a,FHV A12 uitgaand,52.0267,5.6471577,1.8
ED,Ede-Wageningen,PGL03_Ede_6b,ZGV-A50 via Selterskampweg en N782,52.023796,5.6475945,2.12
ED,Ede-Wageningen,PGL03_FV_A13a,Ede-Veenendaal via A30 en A12,52.04538,5.6174545,2.24
"""

KNMI_CORRIDOR_MAPPING = """\
knmi_station_code,knmi_station_name,corridor_id,corridor_name
240,Schiphol,1,Amsterdam-Rotterdam
344,Rotterdam Airport,1,Amsterdam-Rotterdam
240,Schiphol,2,Amsterdam-Utrecht
260,De Bilt,2,Amsterdam-Utrecht
215,Voorschoten,3,Den Haag-Rotterdam
344,Rotterdam Airport,3,Den Haag-Rotterdam
260,De Bilt,4,Utrecht-Eindhoven
370,Eindhoven Airport,4,Utrecht-Eindhoven
260,De Bilt,5,Utrecht-Arnhem
"""

NL_HOLIDAYS = """\
date,holiday_name
2026-01-01,New Year's Day
2026-04-03,Good Friday
2026-04-05,Easter Sunday
2026-04-06,Easter Monday
2026-04-27,King's Day
2026-05-05,Liberation Day
2026-05-14,Ascension Day
2026-05-24,Whit Sunday
2026-05-25,Whit Monday
2026-12-25,Christmas Day
2026-12-26,Second Christmas Day
"""

DIM_OPERATORS = """\
operator_name,full_name,country,operator_type,description
NS,Nederlandse Spoorwegen,NL,national,"State-owned national operator, holds main network concession until 2034. Runs Intercity, Sprinter, and international services."
Arriva,Arriva Netherlands,NL,regional,"Largest regional operator. Runs services in Friesland, Groningen, Drenthe, Gelderland, Limburg, and Overijssel."
Blauwnet,Blauwnet (Keolis),NL,regional,"Regional brand by Keolis. Operates Overijssel lines: Enschede-Almelo, Zwolle-Emmen, Zutphen-Oldenzaal."
Blauwnet A,Blauwnet (Arriva concession),NL,regional,"Blauwnet-branded services operated under Arriva concession in Overijssel."
Blauwnet K,Blauwnet (Keolis concession),NL,regional,"Blauwnet-branded services operated under Keolis concession in Overijssel."
R-net,R-net (multi-operator),NL,regional,"Unified regional brand used by NS, Qbuzz, and others in Randstad area (Zuid-Holland, Utrecht)."
R-net Qb,R-net (Qbuzz),NL,regional,"R-net services operated by Qbuzz, including Merwede-Lingelijn (Dordrecht-Geldermalsen)."
R-net Qbuz,R-net (Qbuzz alt),NL,regional,"Alternate Qbuzz R-net service code."
R-net NS,R-net (NS),NL,regional,"R-net services operated by NS in the Randstad region."
NS Int,NS International,NL,international,"International arm of NS. Operates Intercity Direct, Thalys/Eurostar, and cross-border IC services."
DB,Deutsche Bahn,DE,international,"German national railway. Runs cross-border regional services into the Netherlands (e.g. Arnhem-Dusseldorf)."
Deutsche B,Deutsche Bahn (regional),DE,international,"DB Regio cross-border services including Regionalbahn Westfalen and Euregiobahn to Dutch stations."
Eurobahn,Eurobahn (Keolis DE),DE,cross-border,"German subsidiary of Keolis. Operates Hengelo-Bielefeld and other cross-border services."
NMBS,NMBS/SNCB,BE,international,"Belgian national railway. Runs stopping services Roosendaal-Antwerpen and Maastricht-Liege."
RRReis,RRReis (Arriva),NL,regional,"Regional brand in Gelderland and Overijssel, operated by Arriva."
RRReis A,RRReis (Arriva concession),NL,regional,"RRReis services under Arriva concession."
RRReis K,RRReis (Keolis concession),NL,regional,"RRReis services under Keolis concession."
RRReis Arr,RRReis (Arriva alt),NL,regional,"Alternate Arriva RRReis service code."
VIAS,VIAS Rail,NL,regional,"Regional operator in Limburg, runs Maastricht-Kerkrade and Heerlen-Aachen services."
Breng,Breng (Arriva),NL,regional,"Regional brand in Arnhem-Nijmegen area, operated under Arriva concession."
TCS OV,TCS OV,NL,charter,"Special and charter train services."
TCS,TCS,NL,charter,"Special and charter train services."
Eu Sleeper,European Sleeper,NL/BE,international,"Night train startup (est. 2023). Runs Brussels-Amsterdam-Berlin-Prague and Paris-Berlin overnight services."
GoVolta,GoVolta,NL,international,"Low-cost open-access startup (launched 2026). Amsterdam-Berlin and Amsterdam-Hamburg from EUR 10."
Keolis,Keolis Netherlands,NL,regional,"French-owned operator. Runs Blauwnet services in Overijssel and Valleilijn (Amersfoort-Ede)."
EB,Eurobahn (alt code),DE,cross-border,"Alternate code for Eurobahn cross-border services."
"""

