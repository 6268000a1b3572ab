"""The reports run on general order tables, with SQL that checks them."""
