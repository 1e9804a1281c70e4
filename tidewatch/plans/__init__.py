"""Domain packs: compositions of the operators into the tables an analyst asks for."""
