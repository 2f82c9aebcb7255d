"""Seven accident CSV rows and the 30 fields the line pipeline stores for
each (quotes deleted, split on every comma, first 30 fields kept)."""

# --- fixed values: seven lines of the original accident sample data, verbatim ---
LINES = [
    '20001218X45444,Accident,SEA87LA080,1948-10-24,"MOOSE CREEK, ID",United States,,,,,Fatal(2),Destroyed,,NC6404,Stinson,108-3,No,1,Reciprocating,,,Personal,,2,0,0,0,UNK,Cruise,Probable Cause,',
    '20020917X01657,Accident,ATL82DA027,1982-01-02,"CHAMBLEE, GA",United States,,,PDK,,Non-Fatal,Substantial,Helicopter,N5745Y,Bell,206L-1,No,1,Turbo Shaft,Part 135: Air Taxi & Commuter,NSCH,Unknown,"Rocky Mountain Helicopters, In",0,0,0,1,VMC,Approach,Probable Cause,02-01-1983',
    "20020917X02410,Accident,MIA82FKA05,1982-01-04,SAINT CROIX,,,,STX,ALEXANDER HAMILTON,Fatal(1),Destroyed,Airplane,N5151U,Cessna,206,No,1,Reciprocating,Part 91: General Aviation,,Business,,1,0,1,0,VMC,Taxi,Probable Cause,04-01-1983",
    '20020917X02141,Accident,FTW82FRG20,1982-01-07,"LAREDO, TX",United States,,,LRD,LAREDO INTL,Non-Fatal,Substantial,Airplane,N1698M,Curtis,C46,No,2,Reciprocating,"Part 125: 20+ Pax,6000+ lbs",NSCH,Unknown,,0,0,0,3,VMC,Standing,Probable Cause,07-01-1983',
    "20020917X01897,Incident,CHI82IA026,1982-01-12,\"CHICAGO, IL\",United States,,,ORD,CHICAGO O'HARE INTER'L,Incident,,Airplane,N31031,Lockheed,L-1011,No,3,Turbo Fan,Part 121: Air Carrier,SCHD,Unknown,Trans World Airlines,0,0,0,149,UNK,Cruise,Probable Cause,12-01-1983",
    '20020917X01907,Accident,DCA82AA011,1982-01-13,"WASHINGTON, DC",United States,,,,WASHINGTON NATIONAL,Fatal(78),Destroyed,,N62AF,Boeing,737-222,No,2,Turbo Fan,,SCHD,Unknown,"Air Florida, Inc",78,6,3,0,IMC,Takeoff,Probable Cause,13-01-1983',
    '20020917X01625,Accident,ANC82DA015,1982-01-15,"NEAR NUIQSUT, AK",United States,,,,,Non-Fatal,Substantial,Airplane,N1459T,De Havilland,DHC-2-MK3,No,1,Turbo Prop,Part 135: Air Taxi & Commuter,NSCH,Unknown,"Sea Airmotive, Inc.",0,0,0,4,VMC,Landing,Probable Cause,15-01-1983',
]

# --- fixed values: the 30 stored fields of each line above, from the original's stored table ---
EXPECTED = [
    ("20001218X45444", "Accident", "SEA87LA080", "1948-10-24", "MOOSE CREEK", " ID", "United States", "", "", "", "", "Fatal(2)", "Destroyed", "", "NC6404", "Stinson", "108-3", "No", "1", "Reciprocating", "", "", "Personal", "", "2", "0", "0", "0", "UNK", "Cruise"),
    ("20020917X01657", "Accident", "ATL82DA027", "1982-01-02", "CHAMBLEE", " GA", "United States", "", "", "PDK", "", "Non-Fatal", "Substantial", "Helicopter", "N5745Y", "Bell", "206L-1", "No", "1", "Turbo Shaft", "Part 135: Air Taxi & Commuter", "NSCH", "Unknown", "Rocky Mountain Helicopters", " In", "0", "0", "0", "1", "VMC"),
    ("20020917X02410", "Accident", "MIA82FKA05", "1982-01-04", "SAINT CROIX", "", "", "", "STX", "ALEXANDER HAMILTON", "Fatal(1)", "Destroyed", "Airplane", "N5151U", "Cessna", "206", "No", "1", "Reciprocating", "Part 91: General Aviation", "", "Business", "", "1", "0", "1", "0", "VMC", "Taxi", "Probable Cause"),
    ("20020917X02141", "Accident", "FTW82FRG20", "1982-01-07", "LAREDO", " TX", "United States", "", "", "LRD", "LAREDO INTL", "Non-Fatal", "Substantial", "Airplane", "N1698M", "Curtis", "C46", "No", "2", "Reciprocating", "Part 125: 20+ Pax", "6000+ lbs", "NSCH", "Unknown", "", "0", "0", "0", "3", "VMC"),
    ("20020917X01897", "Incident", "CHI82IA026", "1982-01-12", "CHICAGO", " IL", "United States", "", "", "ORD", "CHICAGO O'HARE INTER'L", "Incident", "", "Airplane", "N31031", "Lockheed", "L-1011", "No", "3", "Turbo Fan", "Part 121: Air Carrier", "SCHD", "Unknown", "Trans World Airlines", "0", "0", "0", "149", "UNK", "Cruise"),
    ("20020917X01907", "Accident", "DCA82AA011", "1982-01-13", "WASHINGTON", " DC", "United States", "", "", "", "WASHINGTON NATIONAL", "Fatal(78)", "Destroyed", "", "N62AF", "Boeing", "737-222", "No", "2", "Turbo Fan", "", "SCHD", "Unknown", "Air Florida", " Inc", "78", "6", "3", "0", "IMC"),
    ("20020917X01625", "Accident", "ANC82DA015", "1982-01-15", "NEAR NUIQSUT", " AK", "United States", "", "", "", "", "Non-Fatal", "Substantial", "Airplane", "N1459T", "De Havilland", "DHC-2-MK3", "No", "1", "Turbo Prop", "Part 135: Air Taxi & Commuter", "NSCH", "Unknown", "Sea Airmotive", " Inc.", "0", "0", "0", "4", "VMC"),
]

KEYS = [line.split(",")[0] for line in LINES]
