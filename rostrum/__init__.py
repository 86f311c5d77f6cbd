"""rostrum — roster-cleaning jobs expressed as Spark DataFrame plans.

Families:
  * ages    — free-text age limits -> min/max ages (profiles A1..A6)
  * names   — provider names -> first/middle/last/designation/organization (N1..N6)
  * headers — spreadsheet header text -> standard column names (H1..H5)
  * roster  — many sheets -> header detection -> standard wide table -> dedupe + audit
  * paths   — path -> prefix, prefix listings
"""

__version__ = "0.1.0"
