"""Declared columns of the tables whose columns are fixed. The other tables declare theirs in schema rows."""

from __future__ import annotations

from tidemark.operators.columns import fields_of

# Column names and declared types, in table order.
ACCOUNT = fields_of(
    """
    id INTEGER
    accountsearchdisplayname STRING
    accountsearchdisplaynamecopy STRING
    acctnumber STRING
    accttype STRING
    cashflowrate STRING
    category1099misc INTEGER
    currency INTEGER
    deferralacct INTEGER
    description STRING
    displaynamewithhierarchy STRING
    eliminate BOOLEAN
    externalid STRING
    fullname STRING
    generalrate STRING
    includechildren BOOLEAN
    inventory BOOLEAN
    isinactive BOOLEAN
    issummary BOOLEAN
    lastmodifieddate DATE
    parent INTEGER
    reconcilewithmatching BOOLEAN
    revalue BOOLEAN
    sspecacct STRING
    subsidiary STRING
    custrecord_acct_bank_account_number STRING
    custrecord_mg_default_department INTEGER
    custrecord_mg_default_division STRING
    custrecord_fam_account_showinfixedasset STRING
    updated_at TIMESTAMP
    """
)

TRANSACTION_LINE = fields_of(
    """
    id INTEGER
    uniquekey INTEGER
    linelastmodifieddate DATE
    accountinglinetype STRING
    actualshipdate DATE
    assemblycomponent BOOLEAN
    blandedcost BOOLEAN
    class STRING
    cleared BOOLEAN
    cleareddate DATE
    closedate DATE
    commitinventory STRING
    commitmentfirm BOOLEAN
    costestimatetype STRING
    createdfrom STRING
    creditforeignamount FLOAT
    custcol_360_do_not_pack BOOLEAN
    custcol_360_hold BOOLEAN
    custcol_360_hold_qty FLOAT
    custcol_360_holdreason INTEGER
    custcol_mg_expected_ready_date DATE
    custcol_mg_fg_promise_date DATE
    custcol_mg_orig_prom_date DATE
    custcol_promise_date DATE
    custcol_red_dot DATE
    debitforeignamount FLOAT
    documentnumber STRING
    donotdisplayline BOOLEAN
    dropship BOOLEAN
    entity STRING
    estgrossprofit FLOAT
    estgrossprofitpercent FLOAT
    expectedshipdate DATE
    expenseaccount STRING
    foreignamount FLOAT
    fulfillable BOOLEAN
    fxamountlinked FLOAT
    hasfulfillableitems BOOLEAN
    inventoryreportinglocation STRING
    isbillable BOOLEAN
    isclosed BOOLEAN
    iscogs BOOLEAN
    isfullyshipped BOOLEAN
    isfxvariance BOOLEAN
    isinventoryaffecting BOOLEAN
    isrevrectransaction BOOLEAN
    item STRING
    itemtype STRING
    kitcomponent BOOLEAN
    landedcostperline BOOLEAN
    linesequencenumber INTEGER
    location STRING
    mainline BOOLEAN
    matchbilltoreceipt BOOLEAN
    memo STRING
    netamount FLOAT
    oldcommitmentfirm BOOLEAN
    paymentmethod STRING
    processedbyrevcommit BOOLEAN
    quantity FLOAT
    quantitybilled FLOAT
    quantitypacked FLOAT
    quantitypicked FLOAT
    quantityrejected FLOAT
    quantityshiprecv FLOAT
    rate FLOAT
    rateamount FLOAT
    shipmethod STRING
    specialorder BOOLEAN
    subsidiary STRING
    taxline BOOLEAN
    transaction INTEGER
    transactiondiscount BOOLEAN
    units STRING
    updated_at TIMESTAMP
    """
)

SALES_TEAM = fields_of(
    """
    contribution FLOAT
    employee STRING(2000)
    isprimary BOOLEAN
    salesrole STRING(2000)
    id STRING(2000)
    transaction INTEGER
    """
)

DECLARED = {
    "Account": ACCOUNT,
    "transactionLine": TRANSACTION_LINE,
    "invoiceSalesTeam": SALES_TEAM,
    "transactionSalesTeam": SALES_TEAM,
}
