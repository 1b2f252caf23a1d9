"""A small credit portfolio as raw CSV files, with the dirt the sources have."""

from __future__ import annotations

import csv
import random
from datetime import date

OCCUPATIONS = (
    "Accountant Architect Developer Doctor Engineer Entrepreneur Journalist Lawyer Manager Mechanic "
    "Media_Manager Musician Scientist Teacher Writer"
).split()
LOANS = [
    "Auto Loan", "Credit-Builder Loan", "Debt Consolidation Loan", "Home Equity Loan", "Mortgage Loan",
    "Not Specified", "Payday Loan", "Personal Loan", "Student Loan",
]
MONTHS = [date(2023 + m // 12, m % 12 + 1, 1).isoformat() for m in range(24)]


def write(path, header, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)


def write_portfolio(folder, customers: int = 240, seed: int = 11) -> dict[str, str]:
    rnd = random.Random(seed)
    attributes, financials, clicks, lms = [], [], [], []
    for i in range(customers):
        cid, start = f"CUS_{i:04d}", i % 18
        risky = rnd.random() < 0.3
        age = rnd.choice([str(rnd.randint(18, 70)), f"{rnd.randint(18, 70)}_", "-500", "4000"])
        ssn = "#F%$D@*&8" if i % 9 == 0 else f"{i:03d}-12-{1000 + i}"
        occupation = "_______" if i % 8 == 0 else OCCUPATIONS[i % 15]
        attributes.append([cid, f"Name {i}", age, ssn, occupation, MONTHS[start]])
        loans = rnd.sample(LOANS, 2)
        financials.append(
            [cid, f"{20000 + 100 * i}.5_", 2000 + i, rnd.randint(1, 9), rnd.randint(1, 9), rnd.randint(3, 30),
             rnd.choice(["2", "3_", "-100", "1200"]), ", and ".join(loans) if i % 10 else "", rnd.randint(-3, 40),
             rnd.choice(["5", "7_", ""]), rnd.choice(["4.3", "_"]), rnd.randint(1, 12), rnd.choice(["Good", "Bad", "Standard", "_"]),
             f"{1000 * (4 if risky else 1) + i}_", 30.5, "12 Years and 3 Months" if i % 7 else "NA",
             rnd.choice(["Yes", "No", "NM"]), 50.25, 80.1,
             rnd.choice(["Low_spent_Small_value_payments", "High_spent_Large_value_payments",
                         "High_spent_Medium_value_payments", "!@9#%8"]), 300.5, MONTHS[start]]
        )
        for m in range(start + 2):
            clicks.append([rnd.randint(-50, 200) + (60 if risky else 0) for _ in range(20)] + [cid, MONTHS[m]])
        for k in range(7):
            if start + k >= 24:
                break
            late = risky and k >= 4
            lms.append([f"{cid}_loan", cid, MONTHS[start], 10, k, 10000, 1000 if k else 0, 0 if late else 1000,
                        1000 if late else 0, 10000 - 1000 * k, MONTHS[start + k]])
    files = {t: str(folder / f"{t}.csv") for t in ("attributes", "financials", "clickstream", "lms")}
    write(files["attributes"], ["Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date"], attributes)
    write(
        files["financials"],
        ["Customer_ID", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate",
         "Num_of_Loan", "Type_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment", "Changed_Credit_Limit",
         "Num_Credit_Inquiries", "Credit_Mix", "Outstanding_Debt", "Credit_Utilization_Ratio", "Credit_History_Age",
         "Payment_of_Min_Amount", "Total_EMI_per_month", "Amount_invested_monthly", "Payment_Behaviour",
         "Monthly_Balance", "snapshot_date"],
        financials,
    )
    write(files["clickstream"], [f"fe_{i}" for i in range(1, 21)] + ["Customer_ID", "snapshot_date"], clicks)
    write(
        files["lms"],
        ["loan_id", "Customer_ID", "loan_start_date", "tenure", "installment_num", "loan_amt", "due_amt", "paid_amt",
         "overdue_amt", "balance", "snapshot_date"],
        lms,
    )
    return files
